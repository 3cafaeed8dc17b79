"""Wide mergeable per-address records: count vectors that add up, sketches that take maxima."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vectors(df: DataFrame, keys: Sequence[str], slots: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """One array<bigint> per vector: how many rows of the keys fall on each slot (0 .. n - 1). Out of range or null adds nothing.

    The counts are conditional sums, so they are added up in the tasks before the shuffle.
    """
    cols = {name: [F.sum((c == i).cast("long")).alias(f"{name}_{i}") for i in range(n)] for name, (c, n) in slots.items()}
    flat = df.groupBy(*keys).agg(*[c for v in cols.values() for c in v])
    arrays = [F.array(*[F.coalesce(F.col(f"{name}_{i}"), F.lit(0)) for i in range(n)]).alias(name) for name, (_, n) in slots.items()]
    return flat.select(*keys, *arrays)


def merge_vectors(df: DataFrame, keys: Sequence[str], sums: Mapping[str, int], maxima: Mapping[str, int] | None = None, rows: str | None = None) -> DataFrame:
    """Adds vectors up element by element (sums) or takes maxima; vectors are named with their lengths. rows: a column with the number of records."""
    maxima = maxima or {}
    cells = [f(F.get(F.col(n), F.lit(i))).alias(f"{n}_{i}") for f, group in ((F.sum, sums), (F.max, maxima)) for n, size in group.items() for i in range(size)]
    flat = df.groupBy(*keys).agg(*cells, *([F.count("*").alias(rows)] if rows else []))
    arrays = [F.array(*[F.col(f"{n}_{i}") for i in range(size)]).alias(n) for n, size in (sums | maxima).items()]
    return flat.select(*keys, *([rows] if rows else []), *arrays)


def fix_day31(queries: Column, days: Column, arpa: Column) -> tuple[Column, Column]:
    """Day 31 and ARPA count of records whose 31st day ran over into the ARPA counter."""
    d31 = F.greatest(F.lit(0), queries - F.aggregate(F.slice(days, 1, 30), F.lit(0).cast("long"), lambda a, x: a + x))
    return d31, arpa - d31


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def log_feature(x: Column) -> Column:
    return F.log10(2 * x + 1)


def count_above(cols: Sequence[str], part: float) -> Column:
    """How many of the columns exceed a part of their maximum."""
    values = F.array(*[F.col(c) for c in cols])
    return F.size(F.filter(values, lambda x: x > part * F.array_max(values)))


def server_groups(records: DataFrame, network: Column, sums: Mapping[str, int], users: DataFrame | None = None) -> DataFrame:
    """One row per network: its first address, its number of servers, and the added vectors; users (network, users) are joined if given, 0 without a row.

    Addresses of one network are merged wherever they stand; no order of the input is needed.
    """
    own = records.withColumn("network", network)
    first = own.groupBy("network").agg(F.min("ip").alias("ip"))
    out = merge_vectors(own, ["network"], sums, rows="servers").join(first, "network")
    return out.join(users, "network", "left").fillna({"users": 0}) if users is not None else out


def merge_levels(records: DataFrame, levels: Sequence[Sequence[str]], sums: Mapping[str, int]) -> list[DataFrame]:
    """Merged records at each level, finest first (for example slice, day, cluster, month, all), each made from the level before."""
    out, at = [], records
    for keys in levels:
        at = merge_vectors(at, keys, sums)
        out.append(at)
    return out


def presence_count(named: Column, estimate: Column, least: int = 0) -> Column:
    """How many names an address asked for: the named ones it asked for and the sketched number of others, `least` at least."""
    return F.greatest(F.lit(least), F.size(F.filter(named, lambda x: x > 0)) + estimate.cast("long"))


def merge_slices(new: DataFrame, path: str, slice_: str, levels: Sequence[Sequence[str]], keys: Sequence[str], sums: Mapping[str, int]) -> None:
    """Merges slices into a kept hierarchy under `path`: folder `slices`, and `level_0` (finest), `level_1`, … for the levels.

    levels: for example (month, cluster, day), (month, cluster), (month,), each a beginning of the one before. A slice that
    comes again replaces its own rows. Only the days, clusters and months that the new slices touch are made anew, each
    from the level below, and replace their own folders; so a run that is repeated, or failed half-way, changes nothing.
    """
    spark = new.sparkSession
    finest = list(levels[0])
    put = lambda df, name, by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{path}/{name}")
    put(new.select(*finest, slice_, *keys, *sums), "slices", [*finest, slice_])
    touched, below = new.select(*finest).distinct(), "slices"
    for i, level in enumerate(levels):
        by = list(level)
        folders = touched.select(*by).distinct()
        rows = spark.read.parquet(f"{path}/{below}")
        rows = rows.select(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in by], *keys, *sums).join(folders, by, "left_semi")  # prunes the folders at run time
        put(merge_vectors(rows, [*by, *keys], sums).select(*by, *keys, *sums), f"level_{i}", by)
        below = f"level_{i}"
