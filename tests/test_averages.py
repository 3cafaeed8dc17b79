"""The averages stage: marks, closing by a later day, labels, and days that are forgotten."""

from __future__ import annotations

from idhealth.streaming import averages

ROW = "ts timestamp, node string, cc string, city string, path string"


def ran(spark, tmp_path, batches, **options):
    """Feeds one file a trigger, in order, and gives what each run published."""
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    seen, runs = [], []
    for i, rows in enumerate(batches):
        (source / f"{i:03}.json").write_text("\n".join(f'{{"ts": "{t}", "node": "{n}", "cc": "{cc}", "city": "{city}", "path": "{p}"}}' for t, n, cc, city, p in rows))
        stream = spark.readStream.schema(ROW).json(str(source))
        df = averages.pattern_averages(stream, "ts", **options)
        df.writeStream.outputMode("append").format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start().awaitTermination()
        rows = sorted((tuple(r) for r in spark.read.schema(df.schema).parquet(str(out)).collect()), key=repr) if any(out.glob("*.parquet")) else []
        runs.append([r for r in rows if r not in seen])
        seen = rows
    return runs


HOUR = 3_600_000_000
LAST = 23 * HOUR + 11 * 60_000_000 + 59_000_000
JAN31, FEB1 = 17197, 17198


def test_cases(spark, tmp_path):
    """Two nodes of one city over three days; others don't fit. A day is published at noon and at its end, by both nodes."""
    rows = [("2017-02-01 23:11:59", "fr1", "fr", "par", "x"), ("2017-02-01 12:00:00", "chi", "us", "chi", "y")]
    for day in ("2017-01-31", "2017-02-01"):
        for time in ("06:00:00", "12:00:00", "18:00:00", "23:11:59"):
            rows += [(f"{day} {time}", n, "us", "lax", f"{day}/{n}") for n in ("lax1", "lax2")]
    rows.append(("2017-02-02 06:00:00", "lax1", "us", "lax", "2017-02-02/lax1"))
    want = [("us-lax", d, at, at == LAST, ["lax1", "lax2"], [f"{day}/lax1", f"{day}/lax2"]) for d, day in ((JAN31, "2017-01-31"), (FEB1, "2017-02-01")) for at in (12 * HOUR, LAST)]
    (got,) = ran(spark, tmp_path, [rows], patterns=[("us-lax", "us", "lax")], hours=12)
    assert got == sorted(want, key=repr)


def test_triggers_and_closing(spark, tmp_path):
    """State goes on over triggers; a node that is silent holds the day until it is seen on the next; marks that were passed at once are one report; a day is forgotten in time."""
    batches = [
        [("2017-01-31 01:00:00", "a", "us", "lax", "a0"), ("2017-01-31 13:00:00", "b", "us", "chi", "b0")],
        [("2017-01-31 19:00:00", "a", "us", "lax", "a1")],  # b is at 13: two marks are passed
        [("2017-02-01 00:30:00", "b", "us", "chi", "b1")],  # closes b: a is at 19
        [("2017-02-01 00:40:00", "a", "us", "lax", "a2"), ("2017-02-01 00:45:00", "a", "us", "lax", "a3")],
        [("2017-02-05 00:00:00", "c", "us", "lax", "c0")],  # moves the watermark on
        [("2017-02-05 00:00:01", "c", "us", "lax", "c1"), ("2017-01-31 23:59:00", "a", "us", "lax", "late")],
    ]
    got = ran(spark, tmp_path, batches, patterns=[("all", None, None), ("lax", None, "lax")], hours=6)
    both = ["a", "b"]
    assert got[0] == [] and got[4] == [] and got[5] == []
    assert got[1] == [("all", JAN31, 13 * HOUR, False, both, ["a1", "b0"]), ("lax", JAN31, 19 * HOUR, False, ["a"], ["a1"])]
    assert got[2] == [("all", JAN31, 19 * HOUR, False, both, ["a1", "b0"])]
    assert got[3] == [("all", JAN31, averages.CLOSED, True, both, ["a1", "b0"]), ("lax", JAN31, averages.CLOSED, True, ["a"], ["a1"])]
