"""Named queries over the given tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signpost.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
