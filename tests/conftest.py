from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "3").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", f"file://{shared}/warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
