"""Interval joins and flattening without nested loops: by buckets of the number line, aligned blocks of addresses, or as-of over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idhealth.sources.shared import stored


def bucketed(ranges: DataFrame, lo: str, hi: str, bits: int) -> DataFrame:
    """A row for each bucket of 2**bits numbers that a range touches."""
    return ranges.withColumn("bucket_", F.explode(F.sequence(F.shiftright(lo, bits), F.shiftright(hi, bits))))


def interval_join(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str, value: str, default: object, bits: int = 16) -> DataFrame:
    """Left join of numbers to disjoint ranges (both ends belong to them); default on a miss."""
    r = bucketed(ranges.select(lo, hi, value), lo, hi, bits)
    own = df.withColumn("bucket_", F.shiftright(key, bits))
    hit = own["bucket_"] == r["bucket_"]
    joined = own.join(r, hit & (F.col(key) >= F.col(lo)) & (F.col(key) <= F.col(hi)), "left")
    return joined.select(*df.columns, F.coalesce(F.col(value), F.lit(default)).alias(value))


def most_specific(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str, value: str, bits: int = 16) -> DataFrame:
    """Adds for distinct keys the value of the shortest range that holds them (then the latest start); null without one."""
    r = bucketed(ranges.select(lo, hi, value), lo, hi, bits)
    keys = df.select(key).distinct().withColumn("bucket_", F.shiftright(key, bits))
    hits = keys.join(r, "bucket_").where((F.col(key) >= F.col(lo)) & (F.col(key) <= F.col(hi)))
    best = hits.groupBy(key).agg(F.min_by(value, F.struct(F.col(hi) - F.col(lo), -F.col(lo), value)).alias(value))
    return df.join(best, key, "left")


DIGITS = "0123456789ABCDEF"
#: Digits that a block's prefix has at least, so that no group holds all keys.
LEAST_DIGITS = 2


def prefix_blocks(ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """A row for each of a range's maximal aligned blocks, as hexadecimal prefix_ and its length bits_ (in digits).

    The blocks of a range are disjoint and make up exactly the range: at most 15 of each length at either end. Where the
    ends first differ stand the digits between; below, the lower end has the digits after its own, the upper one those
    before, down to where only zeros (or Fs) are left. Blocks of fewer than LEAST_DIGITS digits are cut into such.
    """
    a, b, n = F.col("a_"), F.col("b_"), F.length("a_")
    digit = lambda text, j: F.conv(F.substr(text, j + 1, F.lit(1)), 16, 10).cast("int")
    children = lambda head, x, y: F.when(x <= y, F.transform(F.sequence(x, y), lambda v: F.concat(head, F.substr(F.lit(DIGITS), v + 1, F.lit(1))))).otherwise(F.array().cast("array<string>"))
    own = ranges.withColumns({"a_": F.hex(lo), "b_": F.hex(hi)}).where("a_ IS NOT NULL AND b_ IS NOT NULL AND a_ <= b_")
    differ = F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.substr(a, j + 1, F.lit(1)) != F.substr(b, j + 1, F.lit(1)))
    own = own.withColumns({"d_": F.coalesce(F.get(differ, F.lit(0)), n), "za_": F.length(F.regexp_replace(a, "0+$", "")), "zb_": F.length(F.regexp_replace(b, "F+$", ""))})
    d, za, zb = F.col("d_"), F.greatest("za_", F.col("d_") + 1), F.greatest("zb_", F.col("d_") + 1)
    places = lambda z: F.when(z > d + 1, F.sequence(d + 1, z - 1)).otherwise(F.array().cast("array<int>"))
    lower = F.flatten(F.transform(places(za), lambda j: children(F.substr(a, F.lit(1), j), digit(a, j) + (j < za - 1).cast("int"), F.lit(15))))
    upper = F.flatten(F.transform(places(zb), lambda j: children(F.substr(b, F.lit(1), j), F.lit(0), digit(b, j) - (j < zb - 1).cast("int"))))
    # the first digits themselves are whole blocks if nothing but zeros or Fs follows them
    between = children(F.substr(a, F.lit(1), d), digit(a, d) + (za > d + 1).cast("int"), digit(b, d) - (zb > d + 1).cast("int"))
    whole = (F.col("za_") <= d) & (F.col("zb_") <= d)
    blocks = F.when(whole, F.array(F.substr(a, F.lit(1), d))).otherwise(F.concat(lower, between, upper))
    for _ in range(LEAST_DIGITS):
        blocks = F.flatten(F.transform(blocks, lambda p: F.when(F.length(p) < LEAST_DIGITS, children(p, F.lit(0), F.lit(15))).otherwise(F.array(p))))
    return own.withColumn("prefix_", F.explode(blocks)).withColumn("bits_", F.length("prefix_")).drop("a_", "b_", "d_", "za_", "zb_")


def hits_of_bytes(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """Distinct keys with every range that holds them. Keys, lo and hi are bytes of one length (ip_bin: 16), which compare as unsigned.

    A key meets the blocks with one of its own prefixes, of those lengths that occur (at most one for each four bits of a
    key); every meeting is a hit, so ranges that cross a border of many blocks cost no more than others.
    """
    r = prefix_blocks(ranges, lo, hi)
    lengths = sorted(x["bits_"] for x in r.select("bits_").distinct().collect())  # 32 for addresses
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    keys = keys.withColumn("p_", F.explode(F.array(*[F.struct(F.lit(n).alias("bits_"), F.substring(F.hex(key), 1, n).alias("prefix_")) for n in lengths or [0]]))).select(key, "p_.*")
    return keys.join(r, ["bits_", "prefix_"])


#: Rows that one range of an as-of join takes.
ASOF_ROWS = 1_000_000


def asof_join(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str, value: str, default: object) -> DataFrame:
    """Left join to disjoint ranges of any width, numbers or bytes; default on a miss or a null key.

    Keys and starts are range-partitioned together; each key takes the last start before it, within its part or carried
    over from the parts before by a table of one row each. Nothing is exploded, and no range or hot key fills a task:
    rows of one key are dealt over several parts.
    """
    at = F.col(key)
    own = df.select(at.alias("at_"), F.lit(1).alias("kind_"), F.monotonically_increasing_id().alias("salt_"), F.lit(None).cast(ranges.schema[hi].dataType).alias("to_"), F.lit(None).cast(ranges.schema[value].dataType).alias("value_"), F.struct("*").alias("row_"))
    starts = ranges.where(F.col(lo).isNotNull()).select(F.col(lo).alias("at_"), F.lit(0).alias("kind_"), F.lit(-1).cast("long").alias("salt_"), F.col(hi).alias("to_"), F.col(value).alias("value_"), F.lit(None).cast(own.schema["row_"].dataType).alias("row_"))
    both = stored(own.where(at.isNotNull()).unionByName(starts), "asof-rows")
    order = ("at_", "kind_", "salt_")
    parts = max(1, -(-both.count() // ASOF_ROWS))
    dealt = stored(both.repartitionByRange(parts, *order).withColumn("part_", F.spark_partition_id()), "asof-parts")
    start = F.struct("at_", "to_", "value_")
    last = dealt.where("kind_ = 0").groupBy("part_").agg(F.max_by(start, "at_").alias("last_"))
    # a row for each part
    before = dealt.select("part_").distinct().join(last, "part_", "left").withColumn("carried_", F.last("last_", ignorenulls=True).over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))).select("part_", "carried_")
    within = Window.partitionBy("part_").orderBy(*order)
    found = dealt.withColumn("own_", F.last(F.when(F.col("kind_") == 0, start), ignorenulls=True).over(within)).where("kind_ = 1").join(F.broadcast(before), "part_")
    hit = F.coalesce("own_", "carried_")
    out = found.select("row_.*", F.when(F.col("at_") <= hit["to_"], hit["value_"]).alias("hit_"))
    none = df.where(at.isNull()).withColumn("hit_", F.lit(None).cast(ranges.schema[value].dataType))
    return out.unionByName(none).select(*df.columns, F.coalesce("hit_", F.lit(default)).alias(value))


def interval_join_bytes(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str, value: str, default: object) -> DataFrame:
    """interval_join for IPv4 and IPv6 addresses as bytes; null keys get the default."""
    hits = hits_of_bytes(df, key, ranges.select(lo, hi, value), lo, hi).select(key, value)
    return df.join(hits, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def most_specific_bytes(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str, value: str) -> DataFrame:
    """most_specific for IPv4 and IPv6 addresses as bytes: of the ranges around a key the latest start wins, then the earliest end; among nested networks that is the smallest."""
    upto = F.translate(F.hex(hi), "0123456789ABCDEF", "FEDCBA9876543210")
    hits = hits_of_bytes(df, key, ranges.select(lo, hi, value), lo, hi)
    best = hits.groupBy(key).agg(F.max_by(value, F.struct(F.hex(lo), upto, value)).alias(value))
    return df.join(best, key, "left")


def flatten_ranges(ranges: DataFrame, lo: str = "lo", hi: str = "hi", value: str = "value", bits: int = 12) -> DataFrame:
    """Disjoint (lo, hi, value): on each stretch the range that starts latest wins, then the shortest, then the least value; neighbours of one value are merged.

    Ranges are clipped to buckets, which are solved on their own; only the stretches at bucket borders, two for a bucket
    at most, are merged further, in buckets that are LEVEL times as wide from step to step. Within a bucket each range
    becomes its aligned blocks; of the ranges that have a block only the winner stays, summed up in the tasks, and a stretch
    takes the best of the blocks around it, one a length. So what a bucket holds is bounded by its width.
    """
    r = bucketed(ranges.select(F.col(lo).alias("lo"), F.col(hi).alias("hi"), F.col(value).alias("value")), "lo", "hi", bits)
    first, last = F.shiftleft("bucket_", bits), F.shiftleft("bucket_", bits) + ((1 << bits) - 1)
    r = r.withColumns({"a": F.greatest("lo", first), "b": F.least("hi", last)})
    in_bucket = Window.partitionBy("bucket_").orderBy("point")
    rank = F.struct(F.col("lo").alias("lo"), (-F.col("hi")).alias("hi"), (-F.col("value")).alias("least"), F.col("value").alias("value"))
    r = stored(r.groupBy("bucket_", "a", "b").agg(F.max(rank).alias("rank_")), "ranges-clipped")
    points = r.select("bucket_", F.explode(F.array(F.col("a"), F.col("b") + 1)).alias("point")).distinct()
    segments = points.withColumn("next", F.lead("point").over(in_bucket)).where("next IS NOT NULL").select("bucket_", F.col("point").alias("x"), (F.col("next") - 1).alias("y"))
    blocks = r.select(F.explode(aligned_blocks(F.col("a"), F.col("b"), bits)).alias("k_"), "rank_").groupBy("k_.level", "k_.block").agg(F.max("rank_").alias("rank_"))
    around = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bits)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("x"), k).alias("block")))).alias("k_")
    covered = segments.select("bucket_", "x", "y", around).select("bucket_", "x", "y", "k_.*").join(blocks, ["level", "block"]).groupBy("bucket_", "x", "y").agg(F.max("rank_").alias("rank_")).select("bucket_", "x", "y", "rank_.value")
    # what is used twice is written: each level's windows are evaluated once
    left, out, width = stored(merged(covered, ["bucket_"]), "ranges-left"), None, bits
    while width < 63:
        first = F.shiftleft("bucket_", width)
        border = (F.col("x") == first) | (F.col("y") == first + ((1 << width) - 1))
        inner = left.where(~border).select("x", "y", "value")
        out = inner if out is None else out.unionByName(inner)
        width = min(63, width + LEVEL)
        wide = left.where(border).select(F.shiftright("x", width).alias("bucket_"), "x", "y", "value")
        left = stored(merged(wide, ["bucket_"]), "ranges-left")
    out = out.unionByName(left.select("x", "y", "value"))
    return out.select(F.col("x").alias("lo"), F.col("y").alias("hi"), "value")


def aligned_blocks(a: Column, b: Column, bits: int) -> Column:
    """The maximal aligned blocks of 2**level numbers that make up a to b, as an array of (level, block): at most two of each level up to `bits`."""

    def of_level(k: Column) -> Column:
        first, end = -F.call_function("shiftright", -a, k), F.call_function("shiftright", b + 1, k)  # whole blocks of this level, the end exclusive
        block = lambda c, at: F.when((first < end) & c, F.struct(k.alias("level"), at.alias("block")))
        top = k == bits
        return F.array_compact(F.array(block(top | (F.pmod(first, F.lit(2)) == 1), first), block(~top & (F.pmod(end, F.lit(2)) == 1), end - 1)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bits)), of_level))


#: Bits by which buckets get wider from one merging step to the next.
LEVEL = 13


def merged(df: DataFrame, keys: list[str]) -> DataFrame:
    """Joins neighbouring (x, y, value) rows of one value within keys: gaps and islands."""
    w = Window.partitionBy(*keys).orderBy("x")
    new = F.coalesce((F.lag("y").over(w) + 1 != F.col("x")) | (F.lag("value").over(w) != F.col("value")), F.lit(True))
    marked = df.withColumn("new_", new.cast("int")).withColumn("island_", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "island_").agg(F.min("x").alias("x"), F.max("y").alias("y"), F.first("value").alias("value")).drop("island_")
