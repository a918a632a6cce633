"""Registered queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL for the same rows."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            CHECKS[name] = sql
        return query

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from snapmart.registry import (  # noqa: F401
        cleaning,
        decoding,
        dictionaries,
        flattening,
        merging,
        observing,
        storing,
        streams,
        trending,
    )
