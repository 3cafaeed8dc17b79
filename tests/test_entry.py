from __future__ import annotations

import os

import pytest

import __spark_entry__ as e


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_entry(spark):
    df = e.entry(spark)
    assert df.count() == 9 and set(df.columns) == {"bucket", "clients", "load", "pairs", "repeats"}
