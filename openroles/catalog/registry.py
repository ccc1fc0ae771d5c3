"""Registry of catalog queries: a Spark query and, where SQL can say it, its SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from openroles.catalog.views import Views, duckdb_sql

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(views) -> DataFrame`` and optionally the SQL with the same rows."""

    def add(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = duckdb_sql(sql)
        return fn

    return add


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bound(fn):
        return lambda spark, sf_dir: fn(Views(spark, sf_dir))

    return {name: bound(fn) for name, fn in QUERIES.items()}


def sql_texts() -> dict[str, str]:
    _load()
    return dict(SQL)


def _load() -> None:
    from openroles.catalog import (  # noqa: F401  registering is their effect
        employers, feeds, filings, matching, postings, streams, text,
    )
