"""Where queries and their SQL twins are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlake.workload.tables import comparable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, instants: str = "date") -> Callable[[Query], Query]:
    """Register a query, with its SQL twin where one exists; ``instants`` is how its times are compared."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: comparable(build(spark, folder), instants)
        if sql is not None:
            SQL[name] = sql
        return build

    return register
