"""All core queries by name, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qafila.plans import QUERY_SETS


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for part in QUERY_SETS for name, q in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for part in QUERY_SETS for name, q in part.SQL.items()}
