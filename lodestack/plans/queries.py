"""Registered queries and their DuckDB counterparts.

Queries in SQL that both engines read alike are registered once; where dialects differ, the DuckDB text follows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def query(name: str, sql: str | None = None):
    """Register a query of (spark, folder) under a name, with the SQL that gives the same rows."""

    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def run_sql(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run SQL over the tables that follow FROM or JOIN, given to it as frames (no view is left behind)."""
    found = re.compile(rf"\b(from|join)(\s+)({'|'.join(TABLES)})\b", re.I)
    names = {m[3] for m in found.finditer(text)}
    return spark.sql(found.sub(r"\1\2{\3}", text), **{t: table(spark, folder, t) for t in names})


def sql(name: str, text: str, duck: str | None = None) -> None:
    """Register the same SQL for both engines, or a text for each."""
    QUERIES[name] = lambda spark, folder: run_sql(spark, folder, text)
    ORACLES[name] = duck or text


def load() -> None:
    """Import the modules that register queries."""
    from lodestack.plans import engine_queries, relational  # noqa: F401
