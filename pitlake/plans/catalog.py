"""Registry of queries and of the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its oracle."""

    def add(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    """All registered queries."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """All registered oracles."""
    return dict(_SQL)
