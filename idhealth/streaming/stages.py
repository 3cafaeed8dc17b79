"""The streaming chain: parse slices, counters and thresholds by event time, late days, heavy-source cap.

Sources are streams of rows; in production they come from Kafka, in tests from files. State is kept by key in Spark's
store and cut by watermarks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from idhealth.functions.times import micros

MESSAGE = "topic string, cc string, city string, node string, date string, time string, duration string, path string"


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Slice messages of a Kafka topic, parsed from eight comma-separated cells; ts is their event time."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return parse_messages(raw.select(F.col("value").cast("string").alias("value")))


def parse_messages(lines: DataFrame) -> DataFrame:
    own = lines.select(F.from_csv("value", MESSAGE).alias("m")).select("m.*")
    return own.withColumn("ts", F.try_to_timestamp(F.concat_ws(" ", "date", "time"), F.lit("yyyy-MM-dd HH:mm:ss"))).where("ts IS NOT NULL")


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Starts a query that sends rows (all columns, comma-separated) to a Kafka topic, keyed by node."""
    out = df.select(F.col("node").alias("key"), F.to_csv(F.struct(*df.columns)).alias("value"))
    return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], hours: int, late: str = "1 hour") -> DataFrame:
    """Counts by key and tumbling window; a window is final once the watermark passes its end."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, f"{hours} hours").alias("w"), *keys).agg(F.count("*").alias("count"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).select(F.col("w.start").alias("start"), *keys, "count", "first_ts", "last_ts")


def distinct_messages(stream: DataFrame, ts: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Drops messages that come again within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def thresholds(stream: DataFrame, node: str, ts: str, hours: int, late: str = "1 day", keep_days: int = 60) -> DataFrame:
    """(node, mark, last): a node's rows reached the next multiple of `hours` of the day, or another day.

    The first row of a node stores the mark `hours` after midnight (the day's end if hours >= 24), and is reported if it
    is past it. A later row past the stored mark, or of a later day, reports the stored mark; the new mark is the least
    multiple of `hours` after its time, or the day's end. Rows of one trigger are taken in order of time; rows older than
    the watermark are dropped. A node that is silent until the watermark is keep_days past its mark is forgotten.
    """
    kind = stream.schema[node].dataType.simpleString()
    day, step = 86_400_000_000, hours * 3_600_000_000

    def mark_of(t: int, first: bool) -> int:
        begin = t // day * day
        return begin + day - 1 if hours >= 24 else min(begin + (step if first else step * ((t - begin) // step + 1)), begin + day - 1)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        out, at = [], 0
        times = np.sort(np.concatenate([f[ts].to_numpy("datetime64[us]").astype(np.int64) for f in frames]))
        stored = state.get[0] if state.exists else mark_of(int(times[0]), True)
        while (at := int(np.searchsorted(times, stored, "right"))) < len(times):  # the next row past the mark
            t = int(times[at])
            out.append((key[0], stored, t))
            stored = mark_of(t, False)
        state.update((stored,))
        state.setTimeoutTimestamp(max(stored // 1000, state.getCurrentWatermarkMs()) + keep_days * (day // 1000))
        if out:
            yield pd.DataFrame(out, columns=["node", "mark", "last"]).astype({"mark": "datetime64[us]", "last": "datetime64[us]"})

    own = stream.select(F.col(node).alias("node"), F.col(ts).cast("timestamp").alias(ts)).withWatermark(ts, late)
    return own.groupBy("node").applyInPandasWithState(run, f"node {kind}, mark timestamp, last timestamp", "mark long", "append", GroupStateTimeout.EventTimeTimeout)


def pattern_days(stream: DataFrame, ts: str, cc: str | None, city: str | None, late: str = "1 day") -> DataFrame:
    """Per day the slices, nodes and paths of messages that fit a label (None fits all); a day is final once the watermark has passed it."""
    own = stream
    if cc:
        own = own.where(F.col("cc") == cc)
    if city:
        own = own.where(F.col("city") == city)
    days = own.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w")).agg(F.count("*").alias("slices"), F.collect_set("node").alias("nodes"))
    return days.select(F.to_date("w.start").alias("day"), "slices", F.array_sort("nodes").alias("nodes"))


def capped(stream: DataFrame, key: str, ts: str, n: int, late: str = "1 hour") -> DataFrame:
    """(key, start, seen, kept): how many of a key's rows an hour are seen, and kept under a cap of n."""
    counts = stream.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w"), key).agg(F.count("*").alias("seen"))
    return counts.select(key, F.col("w.start").alias("start"), "seen", F.least("seen", F.lit(n)).alias("kept"))


def capped_rows(stream: DataFrame, key: str, ts: str, n: int, late: str = "1 hour") -> DataFrame:
    """The rows that a cap of n a key and hour keeps: the first ones by trigger and time. Counts are forgotten once the watermark has passed the hour.

    A key is one group with a count for each of its open hours, so what a group costs is not paid for every hour.
    """
    hour = 3_600_000_000

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentWatermarkMs()
        known = dict(zip(*state.get, strict=True)) if state.exists else {}
        rows = pd.concat(list(frames))
        at = rows["hour_"].to_numpy() * hour + rows["in_hour_"].to_numpy()
        order = np.argsort(at, kind="stable")
        hours, first, count = np.unique(at[order] // hour, return_index=True, return_counts=True)
        seen = np.array([known.get(h, 0) for h in hours.tolist()])
        place = np.arange(len(at)) - np.repeat(first - seen, count)
        known |= dict(zip(hours.tolist(), (seen + count).tolist(), strict=True))
        known = {h: c for h, c in known.items() if (h + 1) * (hour // 1000) > now}
        state.update((list(known), list(known.values())))
        state.setTimeoutTimestamp(max((max(known, default=0) + 1) * (hour // 1000), now + 1))
        yield rows.iloc[order[place < n]].drop(columns=["hour_", "in_hour_"])

    us = micros(F.col(ts))
    own = stream.withWatermark(ts, late).withColumns({"hour_": F.floor(us / hour).cast("long"), "in_hour_": F.pmod(us, F.lit(hour))})
    return own.groupBy(key).applyInPandasWithState(run, stream.schema, "hours array<long>, seen array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def analyzed(stream: DataFrame, slices: DataFrame, path: str = "path") -> DataFrame:
    """Messages with their slice's row of counters (slices: a static table with a column named like path), for further stages to use; messages without one wait for no one and are dropped."""
    return stream.join(slices, path)


def node_series(stream: DataFrame, ts: str, node: str, values: list[str], hours: int, late: str = "1 day") -> DataFrame:
    """A point of each node's series for each window: number of rows, and the sum of each value; final once the watermark has passed the window."""
    own = stream.withWatermark(ts, late).groupBy(F.window(ts, f"{hours} hours").alias("w"), node).agg(F.count("*").alias("rows"), *[F.sum(v).alias(v) for v in values])
    return own.select(node, F.col("w.start").alias("start"), "rows", *values)


def run_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a query over what its sources have now, and writes Parquet."""
    df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replayable(path: str, keys: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of Parquet: every batch has a folder of its own (batch_id=…), below it one for each key. A batch that is retried replaces its own rows and no others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.write.mode("overwrite")
        (out.partitionBy(*keys) if keys else out).parquet(f"{path}/batch_id={batch_id}")

    return write


def run_replayable(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), mode: str = "append") -> None:
    """Runs a query over what its sources have now; a batch that failed half-way and runs again leaves no row twice."""
    df.writeStream.outputMode(mode).foreachBatch(replayable(path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
