"""Metadata in the names of capture files, metric labels and country codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: yyyymmdd-hhmmss_seconds_address_cc-city_…, the parts after the time optional
SLICE = r"(\d{8})-(\d{6})(?:_(\d+))?(?:_([^_/.]+))?(?:_([a-z]{2})-([a-z]{3}))?[^/]*$"


def parse_slice_name(path: Column) -> Column:
    """date, time, duration_s, node, cc, city of a capture's path; nulls where it doesn't say. cc and city may stand in a folder `cc-city`."""
    part = lambda i: F.nullif(F.regexp_extract(path, SLICE, i), F.lit(""))
    folder = lambda i: F.nullif(F.regexp_extract(path, r"/([a-z]{2})-([a-z]{3})/", i), F.lit(""))
    return F.struct(
        F.try_to_date(part(1), "yyyyMMdd").alias("date"), part(2).alias("time"), part(3).cast("int").alias("duration_s"), part(4).alias("node"), F.coalesce(part(5), folder(1)).alias("cc"), F.coalesce(part(6), folder(2)).alias("city")
    )


def cc_from_number(code: Column) -> Column:
    """Two letters from c and four digits (c13 is A for 1 .. Z for 26 each); other codes stay."""
    digits = F.regexp_extract(code, r"^c(\d{1,2})(\d{2})$", 1).try_cast("int"), F.regexp_extract(code, r"^c(\d{1,2})(\d{2})$", 2).try_cast("int")
    return F.when(code.rlike(r"^c\d{3,4}$"), F.concat(F.char(digits[0] + 64), F.char(digits[1] + 64))).otherwise(code)


def metric_label(key: Column) -> Column:
    """Key text for metric files: backslashes doubled."""
    return F.replace(key, F.lit("\\"), F.lit("\\\\"))


def six_decimals(value: Column) -> Column:
    return F.format_string("%.6f", value.cast("double"))
