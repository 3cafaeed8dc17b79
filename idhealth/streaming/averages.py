"""Daily averages of node patterns: which files are ready to be averaged, kept as keyed state with timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain
from typing import Any
from zlib import crc32

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from idhealth.functions.times import micros

DAY, HOUR = 86_400_000_000, 3_600_000_000
#: Time of a closed node, and the last mark of a day (fixed value: 23:11:59).
CLOSED, LAST_MARK = DAY - 1, 23 * HOUR + 11 * 60_000_000 + 59_000_000

#: A pattern: label, country and city that messages must have (None: any).
Pattern = tuple[str, str | None, str | None]


#: Parts in which a day's nodes are kept.
CHUNKS = 256


def chunk_of(node: str) -> int:
    return crc32(node.encode()) % CHUNKS


class DayPattern(StatefulProcessor):
    """State of one label and day: each node's last time and file, and how far the day is published.

    Nodes are kept in CHUNKS parts by their hashes, of which those with changes are written. How many nodes are behind the
    next mark is counted along, so all of them are looked at only when the mark is passed.
    """

    def __init__(self, hours: int, keep_days: int) -> None:
        self.hours, self.keep_days = hours, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.nodes = handle.getMapState("nodes", "chunk int", "nodes array<string>, at_us array<long>, paths array<string>")
        self.progress = handle.getValueState("progress", "mark long, final boolean")

    def next_mark(self, mark: int, at: int) -> int:
        """The least mark after `at`: the next multiple of the hours, at last LAST_MARK."""
        while mark <= at and mark < LAST_MARK:
            mark += self.hours * HOUR
            mark = mark if mark < DAY else LAST_MARK
        return mark

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        label, day = key
        if self.progress.exists():
            mark, final = self.progress.get()
        else:
            mark, final = min(self.hours * HOUR, LAST_MARK), False
            # a day that is too old for every later message is forgotten
            self.handle.registerTimer((day + 1 + self.keep_days) * (DAY // 1000))
        known = {n: (t, p) for _, v in self.nodes.iterator() for n, t, p in zip(*v, strict=True)}
        own: list[tuple[int, str, str]] = []
        closing: dict[str, int] = {}  # a node's first message of a later day; further ones change nothing
        for r in rows:
            us, node = r["us"], r["node"]
            if us // DAY == day:
                own.append((us, node, r["path"]))
            elif us < closing.get(node, us + 1):
                closing[node] = us
        own.sort()
        behind = sum(t < mark for t, _ in known.values())
        changed: set[int] = set()
        for us, node, path in chain(own, sorted((us, node, None) for node, us in closing.items())):
            before = known.get(node)
            if path is not None:
                known[node] = (us % DAY, path)
            elif before:
                known[node] = (CLOSED, before[1])  # the node is in another day already
            else:
                continue
            changed.add(chunk_of(node))
            behind += (known[node][0] < mark) - (before is not None and before[0] < mark)
            if not final and not behind:
                at = min(t for t, _ in known.values())
                final = at >= LAST_MARK
                mark = self.next_mark(mark, at)
                behind = sum(t < mark for t, _ in known.values())
                nodes = sorted(known)
                yield Row(label=label, day=day, at_us=at, final=final, nodes=nodes, paths=[known[n][1] for n in nodes])
        parts: dict[int, list[tuple[str, int, str]]] = {c: [] for c in changed}
        for node, (t, path) in known.items():
            if (c := chunk_of(node)) in parts:
                parts[c].append((node, t, path))
        for c, part in parts.items():
            self.nodes.updateValue((c,), tuple(list(x) for x in zip(*part, strict=True)))
        self.progress.update((mark, final))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.nodes.clear()
        self.progress.clear()
        return iter(())

    def close(self) -> None:
        pass


def pattern_averages(stream: DataFrame, ts: str, patterns: Sequence[Pattern], hours: int, keep_days: int = 1, late: str = "1 day") -> DataFrame:
    """(label, day, at_us, final, nodes, paths): the files of a day whenever all its nodes have passed the next multiple of `hours`.

    stream: node, cc, city, path and ts. A node's time in a day is that of its last message; a message of a later day, up
    to keep_days later, closes the node. `at_us` is the least time of the day's nodes in microseconds; a day is published
    once for all marks that it has passed, for the last time when its nodes are past 23:11:59. Messages of one trigger
    are taken in order of time; those older than the watermark are dropped. When the watermark is keep_days past the
    day's end, a timer forgets it. Labels and days are keys of their own, so that days are spread.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # keeps several variables and timers
    fits = [F.when((F.lit(cc is None) | (F.col("cc") == cc)) & (F.lit(city is None) | (F.col("city") == city)), F.lit(label)) for label, cc, city in patterns]
    own = stream.select(F.col(ts).cast("timestamp").alias("ts"), F.col("node").cast("string").alias("node"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.array_compact(F.array(*fits)).alias("labels"))
    own = own.where("ts IS NOT NULL AND node IS NOT NULL").withWatermark("ts", late).withColumn("us", micros(F.col("ts")))
    own = own.select("ts", "us", "node", "path", F.explode("labels").alias("label"))
    # a message goes to its own day, and to the days before that it may close its node in
    day = F.floor(F.col("us") / DAY).cast("long")
    own = own.select("ts", "us", "node", "path", "label", F.explode(F.sequence(day - keep_days, day)).alias("day"))
    return own.groupBy("label", "day").transformWithState(DayPattern(hours, keep_days), "label string, day long, at_us long, final boolean, nodes array<string>, paths array<string>", "append", "eventTime")
