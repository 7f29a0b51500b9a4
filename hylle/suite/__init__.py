"""Named queries over the test tables, each with SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
MODULES = ("texts", "urls", "windows", "tables", "runs", "webpages", "plans")


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL it must agree with where SQL can say it."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    import importlib

    for module in MODULES:
        importlib.import_module(f"hylle.suite.{module}")
