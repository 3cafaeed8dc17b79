"""Connected components of a link table by alternating star contractions; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import BROADCAST_IDS, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every id in a link: root is the least id of its component. Ids must not be null.

    Large star then small star until the links no longer change (Kiveris et al., "Connected Components in MapReduce and
    Beyond"). Both steps group by an id with min() only, so a hub is pre-aggregated and its links stay spread; only a
    count and a sum go to the driver.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc")
    before, n = None, edges.count()
    while True:
        side = F.broadcast if n <= BROADCAST_IDS else (lambda df: df)  # least and root have a row per end of a link at most
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(side(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(side(root), "u").select("u", "v", "m")
        edges = written(small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct(), "cc")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
        if now == before:
            break
        before, n = now, now["n"]
    own = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root")
    return own.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
