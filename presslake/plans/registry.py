"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` with an optional
independent DuckDB SQL oracle over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATOR: dict[str, str] = {}


def query(name: str, sql: str | None = None, op: str = ""):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle (None →
    rows-only check), ``op`` the SURVEY §2 operator ids it proves."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        OPERATOR[name] = op
        return fn

    return deco
