"""Batches and slices that come again."""

from __future__ import annotations

from idhealth.operators.ipstats import merge_slices
from idhealth.streaming import stages


def test_retried_batch_replaces_itself(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(f'{{"node": "n{i}", "v": {i}}}\n{{"node": "n", "v": 10}}')
        stream = spark.readStream.schema("node string, v long").json(str(source))
        stages.run_replayable(stream, out, str(tmp_path / "state"), ["node"])
    rows = lambda: sorted((r["node"], r["v"]) for r in spark.read.parquet(out).collect())
    before = rows()
    assert len(before) == 6
    # batch 1 failed after half of its rows were written, and runs again
    stages.replayable(out, ["node"])(spark.createDataFrame([("n1", 1)], "node string, v long"), 1)
    assert len(rows()) == 5
    for _ in range(2):
        stages.replayable(out, ["node"])(spark.createDataFrame([("n1", 1), ("n", 10)], "node string, v long"), 1)
        assert rows() == before


def test_late_and_replayed_slices(spark, tmp_path):
    schema = "month string, cluster string, day int, slice int, ip string, v array<bigint>"
    levels, sums = (("month", "cluster", "day"), ("month", "cluster"), ("month",)), {"v": 2}
    batches = [
        [("m1", "a", 1, 0, "x", [1, 2]), ("m1", "a", 1, 1, "x", [3, 0]), ("m1", "b", 1, 0, "y", [5, 5])],
        [("m1", "a", 2, 0, "x", [7, 0]), ("m2", "a", 1, 0, "x", [1, 1])],
        [("m1", "a", 1, 0, "x", [1, 2])],  # a replay
        [("m1", "a", 1, 1, "x", [30, 0]), ("m1", "a", 1, 2, "z", [9, 9])],  # a corrected slice and a late one
    ]
    path = str(tmp_path / "kept")
    kept = {}
    for batch in batches:
        merge_slices(spark.createDataFrame(batch, schema), path, "slice", levels, ["ip"], sums)
        kept |= {r[:4]: r for r in batch}
        for i, level in enumerate(levels):
            want = {}
            for month, cluster, day, _, ip, v in kept.values():
                k = (*(month, cluster, day)[: 3 - i], ip)
                want[k] = [a + b for a, b in zip(want.get(k, [0, 0]), v, strict=True)]
            got = {tuple(r[c] for c in (*level, "ip")): r["v"] for r in spark.read.parquet(f"{path}/level_{i}").collect()}
            assert got == want, (i, batch)


def test_sketch_levels(spark):
    from idhealth.functions import sketches

    rows = [("a", i % 3, i % 900) for i in range(3000)] + [("b", 0, i) for i in range(450, 1350)] + [("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, d int, v long")
    fine, coarse, all_ = sketches.sketch_levels(df, (["k", "d"], ["k"], []), "v")
    near = lambda x, n: abs(x - n) <= 4 * sketches.SKETCH_ERROR * n
    got = {(r["k"], r["d"]): r["estimate"] for r in fine.collect()}
    assert got["b", 1] == 0 and near(got["a", 0], 300) and near(got["b", 0], 900)
    assert near(all_.first()["estimate"], 1350) and all(near(r["estimate"], 900) for r in coarse.collect())
    a, b = (coarse.where(f"k = '{k}'").withColumn("g", coarse["k"].isNotNull()) for k in "ab")
    assert near(900 + 900 - sketches.estimated_overlap(a, b, ["g"]).first()["both"], 1350)
