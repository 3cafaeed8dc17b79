"""Queries against their SQL on tables that the given ones are too small or too regular for."""

from __future__ import annotations

import datetime
import random
from itertools import pairwise

import duckdb
import pytest
from pyspark.sql import functions as F

from idhealth import registry
from idhealth.operators import ranges

from .test_queries import table

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DAY1 = datetime.datetime(2024, 1, 1)


@pytest.fixture
def same(spark, tmp_path):
    """Writes tables and checks that a query gives on them what its SQL gives."""

    def check(name, **tables):
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for t, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        df = registry.queries()[name](spark, str(tmp_path))
        got = table(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(registry.oracle_sql()[name])
        assert got == table([c[0] for c in cur.description], cur.fetchall())
        return got[1]

    return check


def events(n, user, seconds, kind=lambda i: ("view", "click", "error")[i % 3]):
    return EVENTS, [(i, DAY1 + datetime.timedelta(seconds=seconds(i)), user(i), kind(i), 1.0, f'{{"k": {i % 100}}}') for i in range(n)]


def test_extract_names_with_many_users(same):
    assert len(same("extract_names", events=events(330, lambda i: i, lambda i: 60 * i))) == 30


def test_log_lines_of_one_time(same):
    assert len(same("rsv_log_parse", events=events(40, lambda i: 70 * i, lambda i: i // 4))) == 40


def test_aligned_blocks_make_up_their_range(spark):
    rng = random.Random(4)
    pairs = [(0, 1023), (1024, 2047), (5, 5), (1, 1022), (-1024, -1), (-700, -3)] + [tuple(sorted(1024 * b + rng.randrange(1024) for _ in range(2))) for b in (-2, 0, 7) for _ in range(40)]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("k", ranges.aligned_blocks(F.col("a"), F.col("b"), 10))
    for r in df.collect():
        numbers = [x for k in r.k for x in range(k.block << k.level, (k.block + 1) << k.level)]
        assert sorted(numbers) == list(range(r.a, r.b + 1)) and len(r.k) <= 20


def test_flattened_ranges_that_crowd_a_bucket(spark):
    """100,000 ranges in three buckets: against painting them in order; a stretch isn't joined with every range of its bucket."""
    rng = random.Random(5)
    rows = [(lo, lo + rng.randrange(300), rng.randrange(5)) for lo in (rng.randrange(3000) for _ in range(100_000))]
    painted = {}
    for lo, hi, value in sorted(rows, key=lambda r: (r[0], -r[1], -r[2])):
        painted |= dict.fromkeys(range(lo, hi + 1), value)
    got = ranges.flatten_ranges(spark.createDataFrame(rows, "lo long, hi long, value long"), bits=10).collect()
    assert {x: r.value for r in got for x in range(r.lo, r.hi + 1)} == painted
    assert all(a.hi + 1 < b.lo or a.value != b.value for a, b in pairwise(sorted(got)))
