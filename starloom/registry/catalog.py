"""The list of registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_tables import with_tables

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` states its result."""

    def add(function: Query) -> Query:
        key = name or function.__name__
        _queries[key] = function
        if sql:
            _oracles[key] = sql
        return function

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in _oracles.items()}
