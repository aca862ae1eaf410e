"""Registry of the queries run by the driver: name -> (spark, sf_dir) -> DataFrame,
with the equivalent DuckDB SQL beside each one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None when the operator
    has no SQL equivalent and is checked against brute force in tests)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plans module so that its queries register."""
    from partsmith.plans import (  # noqa: F401
        catalog_queries,
        ingest_queries,
        merge_queries,
        tree_queries,
        vendor_queries,
        index_queries,
        report_queries,
        planner_queries,
        publish_queries,
        stream_queries,
    )
