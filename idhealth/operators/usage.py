"""Query usage by client and name, cache efficiency, client features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gaps(df: DataFrame, keys: Sequence[str], order: Sequence[str], us: str) -> DataFrame:
    """Adds `gap`: microseconds since the row before of the same keys; null for the first."""
    return df.withColumn("gap", F.col(us) - F.lag(us).over(Window.partitionBy(*keys).orderBy(*order)))


def usage(df: DataFrame, keys: Sequence[str], us: str, order: Sequence[str], flags: str, nx: str) -> DataFrame:
    """One row per keys: count, first_us, last_us, least positive gap (0 if all are 0, null if there is none), OR of flags, nx of the first row."""
    g = gaps(df, keys, order, us)
    first = F.struct(*order)
    positive = F.min(F.when(F.col("gap") > 0, F.col("gap")))
    return g.groupBy(*keys).agg(
        F.count("*").alias("count"), F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.coalesce(positive, F.min("gap")).alias("min_gap"), F.bit_or(flags).alias("flags"), F.min_by(nx, first).alias("is_nx")
    )


def repeat_ratio(used: DataFrame, nx: str = "is_nx") -> DataFrame:
    """Per nx value: pairs, repeats (queries less pairs) and their share of all queries."""
    out = used.groupBy(nx).agg(F.count("*").alias("pairs"), (F.sum("count") - F.count("*")).alias("repeats"))
    return out.withColumn("repeat_share", F.col("repeats").cast("double") / (F.col("repeats") + F.col("pairs")))


def bucket_of(value: Column, edges: Sequence[int]) -> Column:
    """Index of the first edge above the value; the last one for anything else, null included."""
    out = F.lit(len(edges) - 1)
    for i in range(len(edges) - 2, -1, -1):
        out = F.when(value < edges[i], F.lit(i)).otherwise(out)
    return out


def delay_buckets(used: DataFrame, client: str, edges_us: Sequence[int]) -> DataFrame:
    """(bucket, clients, load): clients by their least gap; those that never repeat a name go to the last bucket. All buckets are given."""
    by = used.groupBy(client).agg(F.min("min_gap").alias("gap"), F.sum("count").alias("load"))
    counted = by.groupBy(bucket_of(F.col("gap"), edges_us).cast("int").alias("bucket")).agg(F.count("*").alias("clients"), F.sum("load").alias("load"))
    domain = used.sparkSession.range(len(edges_us)).select(F.col("id").cast("int").alias("bucket"))
    return domain.join(counted, "bucket", "left").fillna({"clients": 0, "load": 0})


def average_delay(used: DataFrame, client: str, default_us: int = 600_000_000) -> DataFrame:
    """Per client the mean time between queries for one name; default_us without repeats."""
    out = used.groupBy(client).agg(F.sum(F.col("last_us") - F.col("first_us")).alias("span"), F.sum(F.col("count") - 1).alias("n"))
    return out.select(client, F.when(F.col("n") > 0, F.floor(F.col("span") / F.col("n"))).otherwise(F.lit(default_us)).cast("long").alias("mean_us"))


def client_usage(df: DataFrame, client: str, features: Mapping[str, Column]) -> DataFrame:
    """(feature, clients, users): a client uses a feature if any of its messages does."""
    by = df.groupBy(client).agg(*[F.bool_or(c).alias(n) for n, c in features.items()])
    long = by.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.coalesce(F.col(n), F.lit(False)).alias("used")) for n in features])).alias("x"))
    return long.groupBy("x.feature").agg(F.count("*").alias("clients"), F.sum(F.col("x.used").cast("long")).alias("users"))


def once_per_client(df: DataFrame, client: str, option: str) -> DataFrame:
    """(option, clients): each client counts once for each option value."""
    return df.select(client, option).where(F.col(option).isNotNull()).distinct().groupBy(option).agg(F.count("*").alias("clients"))


def cap_per_key(df: DataFrame, key: str, order: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows of each key, and (key, dropped) for keys with more."""
    ranked = df.withColumn("rank_", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    dropped = df.groupBy(key).agg((F.count("*") - n).alias("dropped")).where("dropped > 0")
    return ranked.where(F.col("rank_") <= n).drop("rank_"), dropped


def filter_addresses(df: DataFrame, address: str, allow: DataFrame, ban: DataFrame) -> DataFrame:
    """Drops rows with a banned address unless it is allowed too. allow and ban have one column named like address."""
    return df.join(ban.join(allow, address, "left_anti"), address, "left_anti")
