"""Registration of queries with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(column: str, alias: str | None = None, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    return (F.round(F.col(column).cast("double"), digits) + F.lit(0.0)).alias(alias or column)


def i64(column: str, alias: str | None = None) -> Column:
    return F.col(column).cast("bigint").alias(alias or column)
