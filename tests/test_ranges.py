"""Ranges of addresses as aligned blocks, and as-of joins, against brute force."""

from __future__ import annotations

import random

import pytest

from idhealth.operators import ranges


def nets(rng, n):
    out = [(0, (1 << 32) - 1), (0x7F000000, 0x80FFFFFF), (0x7FFFFFFF, 0x80000000), (5, 5), (0, 0), (0xFFFFFFFF, 0xFFFFFFFF), (0, 0x0FFFFFFF), (0x10000000, 0x1FFFFFFF), (0x12345678, 0x12345689), (0x00000001, 0xFFFFFFFE)]
    for _ in range(n):
        lo = rng.randrange(1 << 32)
        out.append((lo, min((1 << 32) - 1, lo + rng.choice([0, 1, 15, 16, 255, 70_000, 1 << 24, 1 << 31]))))
        size = 4 * rng.randrange(9)
        out.append((lo >> size << size, lo >> size << size | ((1 << size) - 1)))
    return out


def raw(x):
    return bytearray(x.to_bytes(4, "big"))


def test_blocks_make_up_their_range(spark):
    rows = nets(random.Random(1), 60)
    df = spark.createDataFrame([(i, raw(a), raw(b)) for i, (a, b) in enumerate(rows)] + [(-1, None, raw(1)), (-2, raw(9), raw(8))], "id long, lo binary, hi binary")
    found = {}
    for r in ranges.prefix_blocks(df, "lo", "hi").collect():
        assert len(r["prefix_"]) == r["bits_"] >= ranges.LEAST_DIGITS
        found.setdefault(r["id"], []).append((int(r["prefix_"].ljust(8, "0"), 16), int(r["prefix_"].ljust(8, "F"), 16)))
    assert set(found) == set(range(len(rows)))  # broken ranges have none
    for i, (a, b) in enumerate(rows):
        blocks = sorted(found[i])
        assert (blocks[0][0], blocks[-1][1]) == (a, b)
        assert all(x[1] + 1 == y[0] for x, y in zip(blocks, blocks[1:], strict=False))
        assert len(blocks) <= 256 or (a, b) == (0, (1 << 32) - 1) or b - a > 1 << 28


def test_most_specific_across_borders(spark):
    rng = random.Random(2)
    rows = nets(rng, 40)
    df = spark.createDataFrame([(raw(a), raw(b), f"n{i}") for i, (a, b) in enumerate(rows)], "lo binary, hi binary, value string")
    keys = [rng.randrange(1 << 32) for _ in range(300)] + [x for r in rows for x in r] + [0x80000000, 0x7FFFFFFF]
    got = {bytes(r["k"]): r["value"] for r in ranges.most_specific_bytes(spark.createDataFrame([(raw(k),) for k in keys], "k binary"), "k", df, "lo", "hi", "value").collect()}
    for k in keys:
        best = max((a, -b, f"n{i}") for i, (a, b) in enumerate(rows) if a <= k <= b)
        assert rows[int(got[k.to_bytes(4, "big")][1:])] == (best[0], -best[1])


@pytest.mark.parametrize("rows_per_part", [1_000_000, 37])
def test_asof_join(spark, monkeypatch, rows_per_part):
    monkeypatch.setattr(ranges, "ASOF_ROWS", rows_per_part)
    rng = random.Random(3)
    cuts = sorted(rng.sample(range(10_000), 60))
    blocks = [(a, b - 1 if rng.random() < 0.6 else a + (b - a) // 2, i) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))] + [(20_000, 1 << 60, 999)]
    keys = [rng.randrange(12_000) for _ in range(500)] + [777] * 300 + [1 << 59, 19_999, cuts[0], None, None]
    df = spark.createDataFrame([(i, k, "clash") for i, k in enumerate(keys)], "id long, k long, at_ string")
    got = {r["id"]: r["v"] for r in ranges.asof_join(df, "k", spark.createDataFrame(blocks, "lo long, hi long, v long"), "lo", "hi", "v", -1).collect()}
    assert got == {i: next((v for a, b, v in blocks if k is not None and a <= k <= b), -1) for i, k in enumerate(keys)}
    empty = spark.createDataFrame([], "lo long, hi long, v long")
    assert {r["v"] for r in ranges.asof_join(df, "k", empty, "lo", "hi", "v", -1).collect()} == {-1}
