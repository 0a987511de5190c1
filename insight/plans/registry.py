"""Registry of named queries over the driver's test tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the
whole tables and runs one operator (or a short chain) from the library.
Queries that are expressible in SQL also carry the equivalent DuckDB SQL;
the rest are checked by rows and by tests against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r(c: Column | str, digits: int = 6) -> Column:
    """Round a float result so Spark and the SQL oracle hash equal values alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def i64(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


def load_all() -> None:
    """Import every plan module so its queries register."""
    from insight.plans import (  # noqa: F401
        basket,
        crm,
        measure,
        ml,
        neighbours,
        prep,
        profile,
        recommend,
        relational,
        timeseries,
    )
