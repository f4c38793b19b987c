"""Pair every query with the SQL that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL to compare it to."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        ORACLES[key] = sql
        return function

    return register
