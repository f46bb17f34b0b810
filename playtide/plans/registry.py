"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL where there is an equivalent."""
    def add(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function
    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from playtide.plans import (  # noqa: F401
        digest_queries, listening_queries, playlist_queries, statistics_queries, stream_queries)
