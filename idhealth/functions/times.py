"""Time columns: microseconds, slices, months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts.cast("timestamp_ntz"))


def seconds(ts: Column) -> Column:
    return F.floor(micros(ts) / 1_000_000).cast("long")


def month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def slice_index(ts: Column, width_s: int) -> Column:
    """Number of the width_s-second slice since 1970 that holds ts."""
    return F.floor(micros(ts) / (width_s * 1_000_000)).cast("long")


def slice_of_month(ts: Column, width_s: int = 300) -> Column:
    """Slice within the month, 0 at its first midnight."""
    day_s = (F.dayofmonth(ts) - 1) * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    return F.floor(day_s / width_s).cast("long")
