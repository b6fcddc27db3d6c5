"""Names, Spark plans and SQL twins of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL that gives the same rows where there is one."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def rounded(column: Column | str, places: int = 6) -> Column:
    """Rounded, and without negative zero."""
    return F.round(column, places) + F.lit(0.0)


def stamp(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
