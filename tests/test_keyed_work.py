"""What a text, a key or a day costs grows with its size; results against plain Python."""

from __future__ import annotations

import random
import time
from collections import Counter
from types import SimpleNamespace

from pyspark.sql import functions as F

from idhealth.functions import names
from idhealth.streaming import averages, stages

DAY, HOUR = averages.DAY, averages.HOUR


def escaped(text):
    odd = lambda i, c: not " " <= c <= "~" or c in '",\\' or i == 0 and c == "=" or c == " " and (i in (0, len(text) - 1) or text[i - 1] == " ")
    return "".join("".join(f"\\{b:03}" for b in c.encode()) if odd(i, c) else c for i, c in enumerate(text))


def test_safe_text_of_long_texts(spark):
    rng = random.Random(1)
    short = ["".join(rng.choice(' =",\\ab\té漢😀\n\x7f ') for _ in range(rng.randrange(12))) for _ in range(300)]
    long = "".join(rng.choice(["word ", "  ", "é", ",", "😀x", "\n"]) for _ in range(100_000))
    given = [*short, long, "", " ", "=", "= =", None]
    begin = time.monotonic()
    got = spark.createDataFrame(list(enumerate(given)), "i int, x string").select("i", names.safe_text(F.col("x")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [None if x is None else escaped(x) for x in given]
    assert time.monotonic() - begin < 30


def test_cap_keeps_one_state_a_key(spark, tmp_path):
    """Six triggers of rows up to 40 minutes late, over 60 hours: the first two of every key and hour; a key is one state however many hours are open."""
    rng = random.Random(2)
    (tmp_path / "in").mkdir()
    want, most = Counter(), 0
    for trigger in range(6):
        rows = [(rng.choice("abc"), trigger * 36_000 + rng.randrange(36_000 + 2400 * (trigger > 0)) - 2400 * (trigger > 0)) for _ in range(80)]
        (tmp_path / "in" / f"{trigger}.json").write_text("\n".join(f'{{"k": "{k}", "s": {s}}}' for k, s in rows))
        stream = spark.readStream.schema("k string, s long").json(str(tmp_path / "in")).withColumn("t", F.timestamp_seconds("s"))
        q = stages.capped_rows(stream, "k", "t", 2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        most = max([most, *[p.stateOperators[0].numRowsTotal for p in q.recentProgress]])
        want += Counter((k, s // 3600) for k, s in rows)
    got = Counter((r.k, r.s // 3600) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == {k: min(n, 2) for k, n in want.items()} and most == 3


class Kept:
    """State variables of one key."""

    def __init__(self):
        self.map, self.value = {}, None

    def getMapState(self, *_):  # noqa: N802
        return SimpleNamespace(iterator=lambda: iter(list(self.map.items())), updateValue=self.map.__setitem__)

    def getValueState(self, *_):  # noqa: N802
        return SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=lambda v: setattr(self, "value", v))

    def registerTimer(self, _):  # noqa: N802
        pass


def published(batches, hours=6):
    pattern = averages.DayPattern(hours, 3)
    pattern.init(Kept())
    return [(r["at_us"], r["final"], r["nodes"], r["paths"]) for rows in batches for r in pattern.handleInputRows(("all", 0), iter(rows), None)]


def expected(batches, hours=6):
    known, mark, final, out = {}, hours * HOUR, False, []
    for rows in batches:
        for r in sorted(rows, key=lambda r: (r["us"], r["node"], r["path"])):
            n = r["node"]
            if r["us"] < DAY:
                known[n] = (r["us"], r["path"])
            elif n in known:
                known[n] = (averages.CLOSED, known[n][1])
            else:
                continue
            at = min(t for t, _ in known.values())
            if not final and at >= mark:
                final = at >= averages.LAST_MARK
                while mark <= at and mark < averages.LAST_MARK:
                    mark = mark + hours * HOUR if mark + hours * HOUR < DAY else averages.LAST_MARK
                out.append((at, final, sorted(known), [known[x][1] for x in sorted(known)]))
    return out


def test_days_of_patterns():
    rng = random.Random(3)
    several = 0
    for _ in range(300):
        nodes = [f"n{i}" for i in range(rng.randrange(1, 5))]
        batches = [[{"us": rng.randrange(2 * DAY), "node": rng.choice(nodes), "path": str(rng.randrange(9))} for _ in range(rng.randrange(15))] for _ in range(rng.randrange(1, 5))]
        assert published(batches) == expected(batches)
        several += len(expected(batches)) > 1
    assert several > 50


def test_day_of_many_nodes():
    n = 20_000
    rows = [{"us": q * 6 * HOUR + i, "node": f"n{i}", "path": str(q)} for q in range(5) for i in range(n)]
    begin = time.monotonic()
    assert [x[:2] for x in published([rows])] == [(6 * HOUR, False), (12 * HOUR, False), (18 * HOUR, False), (averages.CLOSED, True)]
    assert time.monotonic() - begin < 15
