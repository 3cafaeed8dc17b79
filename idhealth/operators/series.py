"""Monthly vectors and slice series: gap filling, smoothing, active hours, outliers, traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idhealth.sources.shared import stored

from .quantiles import with_order_statistics


def month_grid(df: DataFrame, month: str) -> DataFrame:
    """(month, i): all months from the first to the last, as yyyy-MM. One row goes in, one per month comes out."""
    span = df.agg(F.min(month).alias("a"), F.max(month).alias("b"))
    day = lambda c: F.to_date(F.concat(F.col(c), F.lit("-01")))
    return span.select(F.posexplode(F.sequence(day("a"), day("b"), F.expr("INTERVAL 1 MONTH"))).alias("i", "d")).select("i", F.date_format("d", "yyyy-MM").alias("month"))


def month_vector(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """(key, vector): one value for each month between the first and the last of all keys, 0 where there is none."""
    grid = F.broadcast(month_grid(df, month))  # a row per month
    summed = df.groupBy(key, F.col(month).alias("month")).agg(F.sum(value).alias("v")).join(grid, "month")
    n = grid.agg(F.count("*").alias("n_"))
    maps = summed.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m")).crossJoin(F.broadcast(n))  # one row
    return maps.select(key, F.transform(F.sequence(F.lit(0), F.col("n_").cast("int") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0))).alias("vector"))


def current_and_average(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """(key, current, average): the value of the last month of all, and the mean of all earlier months (absent ones are 0)."""
    span = df.agg(F.max(month).alias("last_"), F.min(month).alias("first_"))
    number = lambda c: F.substring(c, 1, 4).cast("int") * 12 + F.substring(c, 6, 2).cast("int")
    own = df.crossJoin(F.broadcast(span))  # one row
    n = number("last_") - number("first_")
    current = F.sum(F.when(F.col(month) == F.col("last_"), F.col(value)).otherwise(0))
    earlier = F.sum(F.when(F.col(month) < F.col("last_"), F.col(value)).otherwise(0))
    return own.groupBy(key).agg(current.alias("current"), F.coalesce(F.try_divide(earlier.cast("double"), F.max(n).cast("double")), F.lit(0.0)).alias("average"))


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each keys by order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("r_", F.row_number().over(w)).where("r_ = 1").drop("r_")


def top_names(df: DataFrame, group: Column, name: str, value: str, least: float) -> DataFrame:
    """(group, name, most, sum): names that reach `least` in a slice of the group."""
    return df.where(F.col(value) > least).groupBy(group.alias("group"), F.col(name).alias("name")).agg(F.max(value).alias("most"), F.sum(value).alias("sum"))


def pick_names(first: DataFrame, second: DataFrame, name: str, value: str, n: int = 3) -> DataFrame:
    """The n leading names of two lists; a name of both counts in the first."""
    both = first.select(name, value).unionByName(second.join(first, name, "left_anti").select(name, value))
    return both.orderBy(F.col(value).desc(), F.col(name).asc()).limit(n)


def split_slices(df: DataFrame, us: str, duration_us: int, width_us: int, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Sums by slice; of a row that began f of a slice after its slice's start, f of each value goes to the slice before, if there is one. Scaled to full slices."""
    i = F.floor(F.col(us) / width_us)
    f = (F.col(us) - i * width_us) / F.lit(float(width_us))
    parts = F.explode(F.array(F.struct(i.alias("slice"), F.when(i > 0, 1 - f).otherwise(1.0).alias("w")), F.struct((i - 1).alias("slice"), F.when(i > 0, f).otherwise(0.0).alias("w"))))
    scale = width_us / duration_us if duration_us else 1.0
    own = df.select(*keys, *values, parts.alias("p")).where("p.slice >= 0")
    return own.groupBy(*keys, F.col("p.slice").alias("slice")).agg(*[(F.sum(F.col(v) * F.col("p.w")) * scale).alias(v) for v in values])


def slice_grid(df: DataFrame, key: Sequence[str], slice_: str, values: Sequence[str]) -> DataFrame:
    """A row for each key and each slice from the first to the last of all; absent values are 0."""
    span = df.agg(F.min(slice_).alias("a"), F.max(slice_).alias("b"))
    grid = span.select(F.explode(F.sequence("a", "b")).alias(slice_))
    keys = df.select(*key).distinct() if key else None
    full = keys.crossJoin(F.broadcast(grid)) if key else grid  # a row per slice
    return full.join(df, [*key, slice_], "left").fillna(0, list(values))


#: Slices of one key that a task smooths; with the edge rows of its neighbours.
BLOCK = 4096


def smooth(df: DataFrame, key: Sequence[str], order: str, value: str, width: int = 25, out: str = "smooth", block: int = BLOCK) -> DataFrame:
    """Centred mean over `width` slices; past the ends the first and last values repeat.

    A key's slices follow each other without gaps (see slice_grid). A long series is cut into blocks, each with the
    `width` // 2 rows before and after it, so that one key is not one task; a key's ends are one row.
    """
    half, rest = width // 2, [c for c in df.columns if c not in key]
    if block < half:
        raise ValueError("a block must reach over its neighbours' edge rows")
    at = F.floor(F.col(order) / block)
    within = F.col(order) - at * block
    # a row goes to its own block and, near a border, to the one beside it
    spread = df.withColumn("block_", F.explode(F.array_compact(F.array(at, F.when(within < half, at - 1), F.when(within >= block - half, at + 1)))))
    ends = df.groupBy(*key).agg(F.min_by(value, order).alias("first_"), F.max_by(value, order).alias("last_"), F.min(order).alias("from_"), F.max(order).alias("to_"))
    near = Window.partitionBy(*key, "block_").orderBy(order).rowsBetween(-half, half)
    own = spread.withColumn("near_", F.sum(value).over(near)).where(F.col("block_") == at)
    own = own.join(ends, list(key)) if key else own.crossJoin(F.broadcast(ends))  # one row
    before, after = F.greatest(half - (F.col(order) - F.col("from_")), F.lit(0)), F.greatest(half - (F.col("to_") - F.col(order)), F.lit(0))
    return own.select(*key, *rest, ((F.col("near_") + F.col("first_") * before + F.col("last_") * after) / width).alias(out))


def quiet_slice(df: DataFrame, slice_: str, value: str, per_day: int) -> DataFrame:
    """One row: the slice of the day with the least mean, the earliest if several have it."""
    means = df.groupBy((F.col(slice_) % per_day).alias("slice")).agg(F.avg(value).alias("mean"))
    return means.agg(F.min(F.struct("mean", "slice")).alias("m")).select("m.slice", "m.mean")


def active_mask(df: DataFrame, key: Sequence[str], slice_: str, value: str, start: Column, length: int, per_day: int) -> DataFrame:
    """Adds day and active. A slice is busy above half the key's mean. Each day has a window of `length` slices from `start` on; with a busy slice in it, it is all active. Outside windows nothing is."""
    at = F.col(slice_) - start
    inside = F.pmod(at, F.lit(per_day)) < length
    means = df.groupBy(*key).agg(F.avg(value).alias("mean_"))  # a row a key; only a key's day is a window
    d = df.join(means, list(key)) if key else df.crossJoin(F.broadcast(means))  # one row
    d = d.withColumn("day", F.floor(at / per_day)).withColumn("busy_", F.col(value) > F.col("mean_") / 2).drop("mean_")
    any_busy = F.bool_or(F.col("busy_") & inside).over(Window.partitionBy(*key, "day"))
    return d.withColumn("active", inside & any_busy).drop("busy_")


def daytime_stats(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Per key: count, mean, population deviation, and quartiles by position n // 4 and 3 * (n // 4) of the sorted values, from 0.

    The quartiles are found by refined histograms: no key's values are sorted or held in one task.
    """
    kind = df.schema[value].dataType
    values = df.select(*key, F.col(value).cast("double").alias("v"))
    summary = stored(df.groupBy(*key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")), "daytime")
    quarter = F.floor(F.col("n") / 4)
    out = with_order_statistics(summary, values.where("v IS NOT NULL"), key, {"q1": quarter, "q3": 3 * quarter})
    return out.select(*key, "n", "mean", "deviation", F.col("q1").cast(kind).alias("q1"), F.col("q3").cast(kind).alias("q3"))


def outliers(df: DataFrame, stats: DataFrame, key: Sequence[str], value: str, parts: Sequence[str], floor: float = 100_000) -> DataFrame:
    """Rows above max(mean + 3 deviations, floor, 2 means), with their ratio to the mean and the first greatest of `parts`."""
    limit = F.greatest(F.col("mean") + 3 * F.col("deviation"), F.lit(float(floor)), 2 * F.col("mean"))
    top = F.greatest(*[F.col(p) for p in parts])
    name = F.lit(parts[-1])
    for p in reversed(parts[:-1]):
        name = F.when(F.col(p) == top, F.lit(p)).otherwise(name)
    out = df.join(stats.select(*key, "mean", "deviation"), list(key)) if key else df.crossJoin(F.broadcast(stats))  # one row
    return out.where(F.col(value) > limit).withColumns({"ratio": F.col(value) / F.col("mean"), "dominant": name})


def trace(df: DataFrame, entity: str, slice_: str, folder: str, folders: Sequence[str], value: str) -> DataFrame:
    """A row for each entity and slice of the whole range, a column for each folder; null where there was nothing."""
    span = df.agg(F.min(slice_).alias("a"), F.max(slice_).alias("b")).select(F.explode(F.sequence("a", "b")).alias(slice_))
    grid = df.select(entity).distinct().crossJoin(F.broadcast(span))  # a row per slice
    got = df.groupBy(entity, slice_).pivot(folder, list(folders)).agg(F.sum(value))
    return grid.join(got, [entity, slice_], "left")


def pivot_series(df: DataFrame, date: str, key: str, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(date).pivot(key, list(keys)).agg(F.sum(value)).fillna(0)


def evaluation(df: DataFrame, stats: DataFrame, key: Sequence[str], slice_: str, value: str, floor: float = 100_000) -> DataFrame:
    """(key…, slice, value, average in active slices, outlier limit), for a table with `active` (see active_mask)."""
    limit = F.greatest(F.col("mean") + 3 * F.col("deviation"), F.lit(float(floor)), 2 * F.col("mean"))
    joined = df.join(stats.select(*key, "mean", "deviation"), list(key), "left")
    return joined.select(*key, slice_, value, F.when(F.col("active"), F.col("mean")).alias("average"), limit.alias("limit"))


def outliers_by_key(found: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Per key its greatest outlier and how many there are."""
    return found.groupBy(*key).agg(F.count("*").alias("outliers"), F.max_by("slice", F.struct(value, -F.col("slice"))).alias("slice"), F.max(value).alias(value))
