from __future__ import annotations

import random

from idhealth.operators import populations as p
from idhealth.operators.ranges import flatten_ranges, interval_join, most_specific


def test_concentration_and_load_curve_match_direct_ranking(spark):
    rng = random.Random(11)
    for case in range(4):
        values = [rng.choice([0, 1, 1, 2, 5, 5, 40]) for _ in range(60)] if case else [0, 0, 0]
        df = spark.createDataFrame([("g", i, v) for i, v in enumerate(values)], "g string, e int, v long")
        r = p.concentration(df, ["g"], "e", "v").first()
        down, total = sorted(values, reverse=True), sum(values)
        for part, name in ((0.5, "k50"), (0.9, "k90")):
            cum = k = 0
            for v in down:
                if cum < part * total:
                    k += 1
                cum += v
            assert r[name] == k, (case, name)
        assert (r.total, r.entities) == (total, len(values))
        if not total:
            continue
        want, cum, last = set(), 0, -1
        for i, v in enumerate(down, 1):
            cum += v
            mark = int(cum / (total * 0.1))
            if mark != last or i == len(down):
                want.add((i, v, cum))
            last = mark
        got = {(x.n, x.load, x.cum) for x in p.load_curve(df.select("v"), "v", 0.1).collect()}
        assert got == want


def test_ranges_match_brute_force(spark):
    rng = random.Random(2)
    nets = [(lo, lo + rng.choice([0, 3, 40, 700]), rng.randint(0, 4)) for lo in (rng.randint(0, 3000) for _ in range(120))]
    df = spark.createDataFrame(nets, "lo long, hi long, value long")
    flat = {(r.lo, r.hi, r.value) for r in flatten_ranges(df, bits=6).collect()}
    pick = lambda x: max(((lo, -hi, -v), v) for lo, hi, v in nets if lo <= x <= hi)[1] if any(lo <= x <= hi for lo, hi, _ in nets) else None
    want, cur = set(), None
    for x in range(-1, 4001):
        v = pick(x)
        if cur and cur[1] == v and v is not None:
            continue
        if cur and cur[1] is not None:
            want.add((cur[0], x - 1, cur[1]))
        cur = (x, v)
    assert flat == want
    keys = spark.range(0, 4000, 7).toDF("k")
    best = {r.k: r.value for r in most_specific(keys, "k", df, "lo", "hi", "value", bits=6).collect()}
    for k, v in best.items():
        hits = [((hi - lo, -lo, x), x) for lo, hi, x in nets if lo <= k <= hi]
        assert v == (min(hits)[1] if hits else None)
    disjoint = flatten_ranges(df, bits=6)
    got = {r.k: r.value for r in interval_join(keys, "k", disjoint, "lo", "hi", "value", -1, bits=6).collect()}
    assert got == {k: pick(k) if pick(k) is not None else -1 for k in range(0, 4000, 7)}
