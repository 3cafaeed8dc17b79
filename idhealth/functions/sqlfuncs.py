"""The name and time functions as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFINITIONS = {
    "id_tld": ("name STRING", "STRING", "try_element_at(split(regexp_replace(name, '\\\\.$', ''), '\\\\.'), -1)"),
    "id_sld": ("name STRING", "STRING", "try_element_at(split(regexp_replace(name, '\\\\.$', ''), '\\\\.'), -2)"),
    "id_labels": ("name STRING", "INT", "CASE WHEN name IS NULL OR name = '' THEN 0 ELSE size(split(regexp_replace(name, '\\\\.$', ''), '\\\\.')) END"),
    "id_is_probe": ("name STRING", "BOOLEAN", "name RLIKE '^[A-Za-z]{7,15}$'"),
    "id_is_numeric": ("name STRING", "BOOLEAN", "name RLIKE '^-?[0-9]+$'"),
    "id_safe_ratio": ("a DOUBLE, b DOUBLE", "DOUBLE", "coalesce(try_divide(a, b), 0)"),
    "id_parse_int": ("text STRING", "BIGINT", "try_cast(regexp_replace(trim(text), ',', '') AS BIGINT)"),
}


def register(spark: SparkSession) -> None:
    for name, (args, kind, body) in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
