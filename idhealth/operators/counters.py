"""Long counter tables: building, merging, shares, top lists with a rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def registry_counts(df: DataFrame, registries: Mapping[str, Column]) -> DataFrame:
    """(registry, key, count): each row adds one to a key of every registry; null keys add nothing.

    One pass: the row's keys are exploded and summed map-side before the only shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("registry"), c.cast("string").alias("key")) for name, c in registries.items()])
    return df.select(F.explode(pairs).alias("p")).where("p.key IS NOT NULL").groupBy("p.registry", "p.key").agg(F.count("*").alias("count"))


def merge_counts(df: DataFrame, keys: Sequence[str] = ("registry", "key"), count: str = "count") -> DataFrame:
    """Sums the counters of many summaries by key."""
    return df.groupBy(*keys).agg(F.sum(count).alias(count))


def top_with_rest(df: DataFrame, keys: Sequence[str], key: str, count: str, n: int, rest: Column | str = "-- OTHERS --") -> DataFrame:
    """Keeps the n greatest keys of each group (count down, key up) and sums the others under `rest`.

    rest may depend on the key, for example a length bucket. Rows must be unique by keys + key.
    """
    other = F.lit(rest) if isinstance(rest, str) else rest
    named = top_marked(df, keys, key, count, n).withColumn(key, F.when(F.col("top_"), F.col(key)).otherwise(other))
    return named.groupBy(*keys, key).agg(F.sum(count).alias(count))


#: Parts in which a group is ranked before its first ones are ranked together.
PARTS = 64


def top_marked(df: DataFrame, keys: Sequence[str], key: str, count: str, n: int) -> DataFrame:
    """Adds top_, whether the row is among the n greatest of its group (count down, key up).

    No group is sorted as a whole: only the n first rows of each of its PARTS can be among its n first ones.
    """
    order = (F.col(count).desc(), F.col(key).asc())
    parts = df.withColumn("part_", F.pmod(F.xxhash64(key), F.lit(PARTS)))
    parts = parts.withColumn("rank_", F.row_number().over(Window.partitionBy(*keys, "part_").orderBy(*order)))
    first = parts.where(F.col("rank_") <= n).withColumn("rank_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    rest = parts.where(F.col("rank_") > n)
    return first.withColumn("top_", F.col("rank_") <= n).unionByName(rest.withColumn("top_", F.lit(False))).drop("part_", "rank_")


def merge_summaries(df: DataFrame, capped: Sequence[str], n: int = 256, least: int = 4, compat: bool = False) -> DataFrame:
    """Merges summaries (registry, key, count): registries in `capped` keep their n greatest keys, the rest goes by key length.

    Rows of capped registries with count <= least go to the length registry at once; with compat each of them adds 1, as
    older summaries did, and not its count.
    """
    length = F.concat(F.lit("length_"), F.char_length("key").cast("string"))
    is_capped = F.col("registry").isin(*capped)
    small = is_capped & (F.col("count") <= least)
    rekeyed = df.select(F.when(small, F.lit("LeakByLength")).otherwise(F.col("registry")).alias("registry"), F.when(small, length).otherwise(F.col("key")).alias("key"), (F.when(small, 1).otherwise(F.col("count")) if compat else F.col("count")).cast("long").alias("count"))
    merged = merge_counts(rekeyed)
    cut = top_marked(merged.where(is_capped), ["registry"], "key", "count", n)
    over = cut.where("NOT top_").select(F.lit("LeakByLength").alias("registry"), length.alias("key"), "count")
    kept = cut.where("top_").drop("top_")
    return merge_counts(kept.unionByName(over).unionByName(merged.where(~is_capped)))


def share(num: Column, den: Column) -> Column:
    """num / den as a double; 0 where den is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def shares(df: DataFrame, group: Sequence[str], count: str) -> DataFrame:
    """Adds `share`, of the count in its group's sum."""
    total = F.sum(count).over(Window.partitionBy(*group))
    return df.withColumn("share", share(F.col(count), total))


def keep_share(df: DataFrame, group: Sequence[str], value: str, least: Column | float, small: int = 8) -> DataFrame:
    """Keeps the rows of groups with fewer than `small` rows, and else those with a value of `least` or more."""
    n = F.count("*").over(Window.partitionBy(*group))
    return df.withColumn("n_", n).where((F.col("n_") < small) | (F.col(value) >= least)).drop("n_")


def remainder(base: Column, listed: Column) -> Column:
    """What the listed shares leave of a base, 0 at least."""
    return F.greatest(F.lit(0.0), base - F.coalesce(listed, F.lit(0.0)))


def densify(df: DataFrame, key: str, domain: DataFrame, fill: Mapping[str, int | float]) -> DataFrame:
    """A row for every key of the domain (one column, named like key); missing counters are filled."""
    return domain.join(df, key, "left").fillna(dict(fill))


def parts_distribution(df: DataFrame, parts: str, most: int = 34) -> DataFrame:
    """(parts, count, share) for 0..most; greater values count as most."""
    counted = df.groupBy(F.least(F.col(parts), F.lit(most)).cast("int").alias("parts")).agg(F.count("*").alias("count"))
    domain = df.sparkSession.range(most + 1).select(F.col("id").cast("int").alias("parts"))
    return shares(densify(counted, "parts", domain, {"count": 0}), [], "count")


def coverage(counts: DataFrame, registry: DataFrame) -> DataFrame:
    """Per table_id: share of registered keys that were seen, and share of instances whose key is not registered.

    counts: table_id, key, count. registry: table_id, key.
    """
    seen = counts.groupBy("table_id", "key").agg(F.sum("count").alias("count"))
    both = registry.select("table_id", "key").distinct().withColumn("registered", F.lit(1)).join(seen, ["table_id", "key"], "full_outer")
    return both.groupBy("table_id").agg(
        share(F.sum(F.when(F.col("registered").isNotNull() & F.col("count").isNotNull(), 1).otherwise(0)), F.count("registered")).alias("seen_share"),
        share(F.sum(F.when(F.col("registered").isNull(), F.col("count")).otherwise(0)), F.sum("count")).alias("unregistered_share"),
    )


def extract(summary: DataFrame, registry: str) -> DataFrame:
    """(key, count) of one registry."""
    return summary.where(F.col("registry") == registry).select("key", "count")


def lookup(summary: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row with a column for each wanted (registry, key): its counter, 0 if absent. All lookups are one pass."""
    cells = [F.coalesce(F.sum(F.when((F.col("registry") == r) & (F.col("key") == k), F.col("count"))), F.lit(0)).cast("long").alias(n) for n, (r, k) in wanted.items()]
    return summary.agg(*cells)


def non_tiny(df: DataFrame, total: str, least: int = 1000) -> DataFrame:
    """Rows with more than `least` in all."""
    return df.where(F.col(total) > least)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in order, as a capture's first packets."""
    return df.orderBy(*order).limit(n)


def sampled_largest(df: DataFrame, key: str, value: str, rows: int = 13, seed: int = 0) -> DataFrame:
    """Of a random sample of `rows` rows (by a hash of key and seed, so that reruns agree) the one with the greatest value; ties by key."""
    drawn = df.orderBy(F.md5(F.concat(F.lit(f"{seed} "), F.col(key).cast("string"))), key).limit(rows)
    return drawn.orderBy(F.col(value).desc(), key).limit(1)
