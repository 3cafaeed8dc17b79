"""All queries of the engine's own operators, with the SQL that must give the same rows."""

from __future__ import annotations

from idhealth.plans import files, leaks, metrics, names, populations, ranges, registries, series, statistics, streams, traffic
from idhealth.plans.catalog import QUERIES, SQL, Query

MODULES = (traffic, populations, ranges, names, series, statistics, metrics, registries, leaks, streams, files)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
