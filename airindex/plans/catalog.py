"""Registered queries: name -> (Spark callable(spark, sf_dir), DuckDB oracle SQL or None).

Every query reads the given test tables (or data Spark derives from them), over
whole tables. Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if SQL-expressible) to the catalog."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from airindex.plans import (queries_core, queries_forecast, queries_history, queries_index, queries_io,  # noqa: F401
                                 queries_quality, queries_series, queries_stream,
                                 queries_tables, queries_volume)


_load_all()
