"""The table of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the equivalent SQL if there is one."""

    def register(function: Query) -> Query:
        name = function.__name__.rstrip("_")  # a trailing _ tells it from the operator
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register
