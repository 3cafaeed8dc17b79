"""Exact order statistics of large groups, without sorting or holding a group anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idhealth.sources.shared import stored

#: Bins that a band is cut into, and rows of a band that may be sorted instead.
BINS, SORTED = 4096, 10_000


def order_statistics(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """(g, rank, value) for wanted (g, rank): the value at that place, from 0, of the group's values in order.

    values: g (any type, null or structs with nulls too), v double without null or NaN. Each round cuts the bands that
    still hold a wanted rank into BINS of equal width, counts them with partial sums in the tasks, and goes on with the
    one bin of each rank, from its least to its greatest value. A band of one value is done; once all others have SORTED
    rows at most, these are sorted, one small band at a time.
    """
    g = lambda df: df.withColumn("g_", F.struct("g"))  # noqa: E731  (null groups equal themselves)
    values = g(values.select("g", "v"))
    whole = values.groupBy("g_").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    state = stored(g(wanted.select("g", F.col("rank").cast("long").alias("rank"))).distinct().join(whole, "g_").where("rank >= 0 AND rank < n").withColumn("skip", F.lit(0).cast("long")), "ranks")
    while True:
        open_ = state.where((F.col("lo") < F.col("hi")) & (F.col("n") > SORTED))
        if not open_.take(1):
            break
        bands = stored(open_.select("g_", "lo", "hi", "skip").distinct(), "bands")
        inside = values.join(bands, "g_").where("v BETWEEN lo AND hi")
        # halves first, as the width itself may be too large for a double
        part = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        counted = inside.groupBy("g_", "lo", "hi", "skip", F.least(F.lit(BINS - 1), F.floor(part * BINS)).alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("c").over(Window.partitionBy("g_", "lo", "hi", "skip").orderBy("bin")) - F.col("c")  # BINS rows at most
        counted = counted.withColumn("before", F.col("skip") + before)
        next_ = open_.join(counted, ["g_", "lo", "hi", "skip"]).where("rank >= before AND rank < before + c")
        next_ = next_.select("g_", "g", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("c").alias("n"), F.col("before").alias("skip"))
        done = state.where((F.col("lo") >= F.col("hi")) | (F.col("n") <= SORTED))
        state = stored(done.select(*next_.columns).unionByName(next_), "ranks")
    small = state.where("lo < hi")
    bands = stored(small.select("g_", "lo", "hi", "skip").distinct(), "bands")
    order = Window.partitionBy("g_", "lo", "hi", "skip").orderBy("v")
    placed = values.join(bands, "g_").where("v BETWEEN lo AND hi").withColumn("rank", F.row_number().over(order) - 1 + F.col("skip")).select("g_", "lo", "hi", "skip", "rank", "v")
    found = small.join(placed, ["g_", "lo", "hi", "skip", "rank"]).select("g", "rank", F.col("v").alias("value"))
    return state.where("lo >= hi").select("g", "rank", F.col("lo").alias("value")).unionByName(found)


def with_order_statistics(summary: DataFrame, values: DataFrame, keys: Sequence[str], places: dict[str, Column]) -> DataFrame:
    """Adds to a summary of groups (keys, and what the places use) a column for each place: the value there, interpolated between its neighbours.

    values: the keys and v. places are columns of the summary, counted from 0.
    """
    group = F.struct(*keys)
    asked = summary.select(group.alias("g"), F.explode(F.array(*[F.struct(F.lit(c).alias("name"), p.cast("double").alias("p")) for c, p in places.items()])).alias("x")).select("g", "x.*").where("p IS NOT NULL")
    asked = stored(asked, "places")
    both = asked.select("g", F.explode(F.array(F.floor("p"), F.ceil("p"))).alias("rank"))
    found = stored(order_statistics(values.select(group.alias("g"), "v"), both), "order-statistics")
    side = lambda name, rank: found.select(F.struct("g").alias("g_"), F.col("rank").alias(rank), F.col("value").alias(name))
    near = asked.withColumns({"g_": F.struct("g"), "lower": F.floor("p"), "upper": F.ceil("p")}).join(side("a", "lower"), ["g_", "lower"]).join(side("b", "upper"), ["g_", "upper"])
    value = F.when(F.col("lower") == F.col("upper"), F.col("a")).otherwise((F.col("upper") - F.col("p")) * F.col("a") + (F.col("p") - F.col("lower")) * F.col("b"))
    wide = near.groupBy("g_").agg(*[F.max(F.when(F.col("name") == c, value)).alias(c) for c in places])
    return summary.withColumn("g_", F.struct(group.alias("g"))).join(wide, "g_", "left").drop("g_")
