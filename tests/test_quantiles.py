"""Order statistics by refined histograms against sorting, with ties, extremes, null groups and forced refinement."""

from __future__ import annotations

import random

import numpy as np
import pytest

from idhealth.operators import quantiles
from idhealth.operators.statistics import describe_by


@pytest.mark.parametrize(("bins", "sorted_"), [(4096, 10_000), (4, 3), (7, 0)])
def test_order_statistics(spark, monkeypatch, bins, sorted_):
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "SORTED", sorted_)
    rng = random.Random(bins)
    groups = {
        "ties": [1.0] * 300 + [2.0] * 100 + [-5.0], "one": [3.5], "mixed": [rng.gauss(0, 1) for _ in range(400)], None: [float(rng.randint(0, 9)) for _ in range(200)],
        "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, *[rng.random() * 10.0 ** rng.randint(-5, 5) for _ in range(60)]],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    wanted = [(g, r) for g, vs in groups.items() for r in sorted({0, len(vs) // 4, len(vs) // 2, 3 * (len(vs) // 4), len(vs) - 1})]
    got = quantiles.order_statistics(spark.createDataFrame(rows, "g string, v double").repartition(4), spark.createDataFrame(wanted + [("one", 1), ("none", 0)], "g string, rank long"))
    assert {(r["g"], r["rank"]): r["value"] for r in got.collect()} == {(g, r): sorted(groups[g])[r] for g, r in wanted}


def test_describe_by(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", None]), rng.choice([rng.random(), 1.0, None, float("nan")]), rng.randint(0, 5)) for _ in range(500)] + [("empty", None, 1)]
    got = {(r["s"], r["column"]): r for r in describe_by(spark.createDataFrame(rows, "s string, x double, y int"), ["s"], ["x", "y"]).collect()}
    for s in ("a", None):
        x = [r[1] for r in rows if r[0] == s and r[1] is not None and r[1] == r[1]]
        r = got[s, "x"]
        assert r["count"] == len(x)
        assert [r["min"], r["q1"], r["median"], r["q3"], r["max"]] == pytest.approx(np.percentile(x, [0, 25, 50, 75, 100]).tolist())
    assert got["empty", "x"]["median"] is None and got["empty", "y"]["q1"] == 1


@pytest.mark.parametrize("block", [12, 13, 50, 4096])
def test_smooth_in_blocks(spark, block):
    """One long key in many blocks, one that begins inside a block, and one shorter than the window."""
    from idhealth.operators.series import smooth

    rng = random.Random(block)
    series = {"long": (-7, [rng.random() for _ in range(333)]), "other": (100, [rng.random() for _ in range(60)]), "short": (5, [1.0, 4.0, 2.0])}
    rows = [(k, at + i, v) for k, (at, vs) in series.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    got = {(r["k"], r["s"]): r["smooth"] for r in smooth(spark.createDataFrame(rows, "k string, s long, v double"), ["k"], "s", "v", block=block).collect()}
    want = {}
    for k, (at, vs) in series.items():
        padded = [vs[0]] * 12 + vs + [vs[-1]] * 12
        want |= {(k, at + i): sum(padded[i : i + 25]) / 25 for i in range(len(vs))}
    assert got == pytest.approx(want)


def test_categorize_takes_the_least_entities(spark):
    from pyspark.sql import functions as F

    from idhealth.operators.populations import categorize

    rows = [(i, i % 3, 1) for i in range(500)] + [(None, 0, 5)]
    got = {r["category"]: r for r in categorize(spark.createDataFrame(rows, "e long, c int, v long"), {"c": (F.col("c"), 0.5, 1.5)}, "v", "e", 4).collect()}
    assert {k: (r["count"], r["load"], r["samples"]) for k, r in got.items()} == {"l": (168, 172, [0, 3, 6, 9]), "m": (167, 167, [1, 4, 7, 10]), "H": (166, 166, [2, 5, 8, 11])}
