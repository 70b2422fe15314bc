"""All registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("text", "corpus", "retrieval", "entities", "evidence", "events", "grounding", "rules", "layers", "checks", "sinks")

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL where SQL can express it."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def _load() -> None:
    for name in MODULES:
        import_module(f"corpusloom.plans.{name}")


def oracle_sql_of(name: str) -> str:
    """The SQL of a query that has been registered already."""
    return _sql[name]


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
