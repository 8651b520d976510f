"""Registered queries over the given tables, each with its check in SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (
    "payloads",
    "ingest",
    "features",
    "models",
    "scoring",
    "baskets",
    "report",
    "enrichment",
    "history",
)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def load() -> None:
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"shelfwise.registry.{module}")
