"""Dealing of fingerprints to shards: rows in proportion, every link in one shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from idhealth.llm import simhash


def near(rng, n):
    """n fingerprints of n / 2 pairs that differ in three bits at the most."""
    x = rng.integers(0, 1 << 63, n // 2, np.uint64) * np.uint64(2)
    y = x.copy()
    for _ in range(simhash.RADIUS):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    return x, y


@pytest.mark.parametrize("n", [2_000, 10_000, 50_000])
def test_rows_grow_with_the_fingerprints(n):
    x, y = near(np.random.default_rng(n), n)
    both = np.concatenate([x, y])
    bounds = simhash.field_bounds(both[::7], n // 100)
    out = pa.Table.from_batches(list(simhash.shard_rows(bounds)(iter([pa.record_batch([pa.array(both.view(np.int64))], ["fp"])]))))
    assert out.num_rows == simhash.FIELDS * n
    shard = out.column("shard").to_numpy().reshape(simhash.FIELDS, n)
    assert (shard[:, : n // 2] == shard[:, n // 2 :]).any(axis=0).all()
    assert np.bincount(shard.ravel()).max() < 400


def test_one_shard_takes_each_once():
    fp = pa.record_batch([pa.array([1, 2, -3])], ["fp"])
    out = pa.Table.from_batches(list(simhash.shard_rows(simhash.field_bounds(np.array([1], np.uint64), 1))(iter([fp]))))
    assert out.to_pydict() == {"shard": [0, 0, 0], "fp": [1, 2, -3]}
