"""Query registry: name -> (Spark callable, optional DuckDB oracle SQL).

Each query reads the driver tables under ``sf_dir`` (stand-ins for market
data, see README) in full and returns a DataFrame. The oracle SQL computes the
same rows with the same column names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL when SQL can express it)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from marketlake.plans import (  # noqa: F401
        history_queries,
        io_queries,
        job_queries,
        macro_queries,
        ranking_queries,
        series_queries,
        store_queries,
        stream_queries,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
