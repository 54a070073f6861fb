"""All registered queries and their SQL, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, audits, curations, event_locked, exports, populations, recordings, sessions

MODULES = (event_locked, alignment, populations, curations, exports, sessions, recordings, audits)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
