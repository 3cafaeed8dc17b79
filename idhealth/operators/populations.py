"""Populations of resolvers and other entities: concentration, load curves, classes, overlaps, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .counters import share


def runs(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """(group…, value, n_, before_, ahead_): each distinct value with its entities, and the sum and number of entities with greater values.

    Entities of one value are alike in any ranking, so values are counted first. Sums run within bands of values, FINE for
    each power of two; the bands' own sums (a few thousand rows a group) are added to them.
    """
    counted = df.groupBy(*group, value).agg(F.count("*").alias("n_"))
    v = F.col(value).cast("double")
    counted = counted.withColumn("band_", (F.signum(v) * F.ceil(F.log2(F.abs(v) + 1) * FINE)).cast("int"))
    above = lambda *keys: Window.partitionBy(*keys).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    product = F.col(value) * F.col("n_")
    higher = Window.partitionBy(*group).orderBy(F.col("band_").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = counted.groupBy(*group, "band_").agg(F.sum(product).alias("p_"), F.sum("n_").alias("c_"))
    bands = bands.select(*group, "band_", F.coalesce(F.sum("p_").over(higher), zero).alias("p_"), F.coalesce(F.sum("c_").over(higher), zero).alias("c_"))
    within = counted.withColumns({"before_": F.coalesce(F.sum(product).over(above(*group, "band_")), zero), "ahead_": F.coalesce(F.sum("n_").over(above(*group, "band_")), zero)})
    same = [F.col(f"a.`{g}`").eqNullSafe(F.col(f"b.`{g}`")) for g in [*group, "band_"]]
    joined = within.alias("a").join(bands.alias("b"), same)
    return joined.select(*[F.col(f"a.`{g}`") for g in [*group, value, "n_"]], (F.col("a.before_") + F.col("b.p_")).alias("before_"), (F.col("a.ahead_") + F.col("b.c_")).alias("ahead_"))


#: Bands of values for each power of two.
FINE = 16


def concentration(df: DataFrame, group: Sequence[str], entity: str, value: str, parts: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Per group: total, entities, and k50, k90 and so on: the fewest entities, greatest first, that hold each part of the total."""
    by = df.groupBy(*group, entity).agg(F.sum(value).alias(value))
    r = runs(by, value, group).withColumn("total_", F.sum(F.col(value) * F.col("n_")).over(Window.partitionBy(*group)))

    def needed(p: float) -> Column:
        left = F.lit(float(p)) * F.col("total_") - F.col("before_")  # what greater values leave open
        return F.when((left > 0) & (F.col(value) > 0), F.least(F.col("n_"), F.ceil(left / F.col(value)))).when(left > 0, F.col("n_")).otherwise(0)

    ks = [F.sum(needed(p)).cast("long").alias(f"k{round(p * 100)}") for p in parts]
    return r.groupBy(*group).agg(F.sum(F.col(value) * F.col("n_")).alias("total"), F.sum("n_").alias("entities"), *ks)


def load_curve(df: DataFrame, value: str, step: float) -> DataFrame:
    """The cumulative load curve of entities (one row each), greatest first: (n, load, cum, share) at the first entity, at the first one past each `step` part of the total, and at the last one."""
    total = df.agg(F.sum(value).alias("total_"), F.count("*").alias("count_"))
    r = runs(df, value).crossJoin(F.broadcast(total))  # one row
    v, n, before, width = F.col(value), F.col("n_"), F.col("before_"), F.col("total_") * F.lit(float(step))
    first, last = F.floor(before / width) + 1, F.floor((before + n * v) / width)
    crossings = F.when((v > 0) & (last >= first), F.transform(F.sequence(first, F.greatest(first, last)), lambda m: F.greatest(F.lit(1), F.least(n, F.ceil((m * width - before) / v))).cast("long")))
    ends = F.array_compact(F.array(F.when(F.col("ahead_") == 0, F.lit(1).cast("long")), F.when(F.col("ahead_") + n == F.col("count_"), n)))
    places = F.explode(F.array_distinct(F.concat(F.coalesce(crossings, F.array().cast("array<long>")), ends))).alias("j_")
    out = r.select(v.alias("load"), "before_", "ahead_", "total_", places)
    cum = F.col("before_") + F.col("j_") * F.col("load")
    return out.select((F.col("ahead_") + F.col("j_")).alias("n"), "load", cum.alias("cum"), share(cum, F.col("total_")).alias("share"))


def overlap(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(part, count, value): keys only in left, in both (once with each side's value), only in right."""
    both = left.select(key, F.col(value).alias("l")).join(right.select(key, F.col(value).alias("r")), key, "full_outer")
    part = F.when(F.col("r").isNull(), F.array(F.struct(F.lit("left only").alias("part"), F.col("l").alias("v"))))
    part = part.when(F.col("l").isNull(), F.array(F.struct(F.lit("right only").alias("part"), F.col("r").alias("v"))))
    part = part.otherwise(F.array(F.struct(F.lit("both, left value").alias("part"), F.col("l").alias("v")), F.struct(F.lit("both, right value").alias("part"), F.col("r").alias("v"))))
    return both.select(F.explode(part).alias("x")).groupBy("x.part").agg(F.count("*").alias("count"), F.sum("x.v").alias("value"))


def log_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(…, decade, count, sum): entities by floor(log10(value)); values below 1 go to decade -1."""
    decade = F.when(F.col(value) >= 1, F.char_length(F.floor(value).cast("string")) - 1).otherwise(F.lit(-1)).cast("int")
    return df.groupBy(*by, decade.alias("decade")).agg(F.count("*").alias("count"), F.sum(value).alias("sum"))


def cross_path(df: DataFrame, entity: str, cluster: str, value: str, least: float = 0) -> DataFrame:
    """(dominant, cluster, value, share): entities by the cluster with most of their value, and where that value goes."""
    by = df.groupBy(entity, cluster).agg(F.sum(value).alias("v"))
    total = by.groupBy(entity).agg(F.sum("v").alias("all"), F.max_by(cluster, F.struct("v", cluster)).alias("dominant")).where(F.col("all") >= least)
    matrix = by.join(total, entity).groupBy("dominant", F.col(cluster).alias("cluster")).agg(F.sum("v").alias("value"))
    return matrix.withColumn("share", share(F.col("value"), F.sum("value").over(Window.partitionBy("dominant"))))


def rank_limit(df: DataFrame, value: str, n: int) -> DataFrame:
    """One row: mean of the values of ranks n and n + 1 (the least value, if there are no more than n rows), and the greatest."""
    top = df.select(value).orderBy(F.col(value).desc()).limit(n + 1)
    r = top.withColumn("rank_", F.row_number().over(Window.orderBy(F.col(value).desc())))  # n + 1 rows at most
    return r.agg(F.count("*").alias("c"), F.min(value).alias("least"), F.avg(F.when(F.col("rank_") >= n, F.col(value))).alias("mid"), F.max(value).alias("largest")).select(F.when(F.col("c") > n, F.col("mid")).otherwise(F.col("least").cast("double")).alias("limit"), "largest")


def rollup_chain(df: DataFrame, levels: Sequence[str], value: str, most: str) -> DataFrame:
    """Sums of value and maximum of `most` at each level of a hierarchy (finest first), with the number of finest entities.

    level is the column's name, name its value. One grouping-sets pass.
    """
    finest = df.groupBy(*levels).agg(F.sum(value).alias("value"), F.max(most).alias("most"))
    long = F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(x).cast("string").alias("name")) for x in levels]))
    return finest.select("value", "most", long.alias("x")).groupBy("x.level", "x.name").agg(F.sum("value").alias("value"), F.max("most").alias("most"), F.count("*").alias("members"))


def projections(df: DataFrame, kinds: Mapping[str, Sequence[Column]], values: Sequence[str]) -> DataFrame:
    """(kind, key, sums…): each row is added to a key of every kind; the key's parts are joined by /."""
    key = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.concat_ws("/", *[c.cast("string") for c in cols]).alias("key")) for k, cols in kinds.items()]))
    return df.select(*values, key.alias("x")).groupBy("x.kind", "x.key").agg(*[F.sum(v).alias(v) for v in values])


def cluster_totals(df: DataFrame, cluster: str, instance: str, entity: str, value: str) -> DataFrame:
    """Sums and distinct entities per cluster and instance, per cluster (instance null), and for all (both null)."""
    rolled = df.rollup(cluster, instance).agg(F.sum(value).alias("value"), F.countDistinct(entity).alias("entities"))
    return rolled


def class_share(df: DataFrame, rules: Mapping[str, Column], default: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(…, class, count, load, share of load): the first rule that holds names the class."""
    name = F.lit(default)
    for k, c in reversed(rules.items()):
        name = F.when(c, F.lit(k)).otherwise(name)
    out = df.groupBy(*by, name.alias("class")).agg(F.count("*").alias("count"), F.sum(value).alias("load"))
    return out.withColumn("share", share(F.col("load"), F.sum("load").over(Window.partitionBy(*by))))


def category_key(criteria: Mapping[str, tuple[Column, float, float]]) -> Column:
    """One letter a criterion: l up to its low bound, H from its high bound on, m between."""
    return F.concat(*[F.when(c <= low, F.lit("l")).when(c >= high, F.lit("H")).otherwise(F.lit("m")) for c, low, high in criteria.values()])


#: Parts of a category that are ranked before their first entities are ranked together.
PARTS = 64


def categorize(df: DataFrame, criteria: Mapping[str, tuple[Column, float, float]], value: str, entity: str, samples: int = 10) -> DataFrame:
    """(category, count, load, samples): the samples are the least entities of a category, as a list of at most `samples`.

    A category may hold most rows: counts are summed in the tasks, and only the first `samples` of each of its PARTS are ranked together.
    """
    keyed = df.withColumn("category", category_key(criteria))
    part = F.pmod(F.xxhash64(entity), F.lit(PARTS))
    by_part = keyed.groupBy("category", part.alias("part_")).agg(F.count("*").alias("count"), F.sum(value).alias("load"))
    total = by_part.groupBy("category").agg(F.sum("count").alias("count"), F.sum("load").alias("load"))
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(entity))
    first = keyed.where(F.col(entity).isNotNull()).select("category", entity, part.alias("part_")).withColumn("rank_", rank("category", "part_")).where(F.col("rank_") <= samples)
    first = first.withColumn("rank_", rank("category")).where(F.col("rank_") <= samples).groupBy("category").agg(F.sort_array(F.collect_list(entity)).alias("samples"))
    kind = df.schema[entity].dataType.simpleString()
    return total.join(first, "category", "left").withColumn("samples", F.coalesce("samples", F.array().cast(f"array<{kind}>"))).select("category", "count", "load", "samples")


def step_histogram(df: DataFrame, criteria: Mapping[str, tuple[Column, float, float]]) -> DataFrame:
    """(criterion, bin, count): floor(value / step), the last bin for values over the maximum. criteria: name to (value, step, maximum)."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("criterion"), F.floor(F.least(c, F.lit(top)) / step).cast("long").alias("bin")) for k, (c, step, top) in criteria.items()]))
    return df.select(cells.alias("x")).groupBy("x.criterion", "x.bin").agg(F.count("*").alias("count"))


def resolver_metrics(df: DataFrame, load: str, nx: str, users: str, limit: int) -> DataFrame:
    """(metric, key, resolvers, load): total, five classes, and decades and twenty NX-ratio bins of the top class. Empty bins are given."""
    kind = F.when(F.col(users) >= limit, "apnic-top").when(F.col(users) > 0, "apnic-others").when(F.col(load) < 1000, "tiny").when((F.col(load) >= 100_000) & (0.1 * F.col(load) > F.col(nx)), "positive").otherwise("else")
    k = df.withColumn("class_", kind)
    decade = F.lit(8)
    for i in range(7, 0, -1):
        decade = F.when(F.col(load) < 10 ** (i + 1), F.lit(i)).otherwise(decade)
    nx_bin = F.least(F.floor(share(F.col(nx), F.col(load)) * 20), F.lit(19)).cast("int")
    top = F.col("class_") == "apnic-top"
    cells = F.array_compact(F.array(
        F.struct(F.lit("total").alias("metric"), F.lit("all").alias("key")), F.struct(F.lit("class").alias("metric"), F.col("class_").alias("key")),
        F.when(top, F.struct(F.lit("decade").alias("metric"), decade.cast("string").alias("key"))), F.when(top, F.struct(F.lit("nx").alias("metric"), nx_bin.cast("string").alias("key"))),
    ))
    got = k.select(load, F.explode(cells).alias("x")).groupBy("x.metric", "x.key").agg(F.count("*").alias("resolvers"), F.sum(load).alias("load"))
    names = [("total", "all")] + [("class", c) for c in ("apnic-top", "apnic-others", "tiny", "positive", "else")] + [("decade", str(i)) for i in range(1, 9)] + [("nx", str(i)) for i in range(20)]
    domain = df.sparkSession.createDataFrame(names, "metric string, key string")
    return domain.join(got, ["metric", "key"], "left").fillna({"resolvers": 0, "load": 0})


def enrich(df: DataFrame, dim: DataFrame, on: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join to a dimension; defaults where it has no row. Spark broadcasts the dimension if its size allows."""
    return df.join(dim, on, "left").fillna(dict(defaults))


def suffix_histogram(df: DataFrame, number: Column, kind: Column, width: int = 16, bins: int = 16) -> DataFrame:
    """(class, bin, count): entities by the low part of their number, for example the last octet of an address."""
    cell = F.floor((number % (width * bins)) / width).cast("int")
    return df.groupBy(kind.alias("class"), cell.alias("bin")).agg(F.count("*").alias("count"))


def profile(df: DataFrame, entity: str, kind: str, kinds: Sequence[str], value: str) -> DataFrame:
    """One row per entity with the sum of value for each of the kinds (0 if none), and their total."""
    sums = [F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(value))), F.lit(0)).alias(k) for k in kinds]
    return df.groupBy(entity).agg(*sums, F.sum(value).alias("total"))


def reduce_addresses(df: DataFrame, address: str, kind: str, value: str, delay: str, slice_: str, kinds: Sequence[str]) -> DataFrame:
    """Per address: counts by kind, total, least positive delay, distinct slices."""
    sums = [F.sum(F.when(F.col(kind) == k, F.col(value)).otherwise(0)).alias(k) for k in kinds]
    return df.groupBy(address).agg(*sums, F.sum(value).alias("total"), F.min(F.when(F.col(delay) > 0, F.col(delay))).alias("min_delay"), F.countDistinct(slice_).alias("slices"))
