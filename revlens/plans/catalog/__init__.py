"""Registered queries over the given tables, each next to its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame."""

    def register(fn: Callable) -> Callable:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load() -> None:
    from revlens.plans.catalog import features, metrics, models, sinks, tables, vectors  # noqa: F401
