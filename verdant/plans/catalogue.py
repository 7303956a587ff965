"""Registry of the core queries and of the DuckDB statements they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its DuckDB statement if there is an honest one."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if oracle is not None:
            _ORACLES[name] = oracle
        return function

    return register


def _load() -> None:
    from verdant.plans import load_all

    load_all()


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
