"""Query registry. A query is a function (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from evalspark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name that starts with its inventory id."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def r6_sql(expression: str) -> str:
    return f"(round(({expression})::DOUBLE, 6) + 0.0::DOUBLE)"
