"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.plans import core, core_sql, skew


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core.QUERIES | skew.QUERIES


def oracle_sql() -> dict[str, str]:
    return core_sql.SQL | skew.SQL


flagship = core.flagship
