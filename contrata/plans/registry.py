"""Named queries over the driver's tables, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Adds a query under a name; oracle: DuckDB SQL with the same rows."""

    def add(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = query
        if oracle:
            _ORACLES[name] = oracle
        return query

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
