"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from idhealth import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def table(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(registry.oracle_sql()[name])
    assert got == table([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0
