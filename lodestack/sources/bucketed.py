"""Bucketed tables, whose joins on the bucket key need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lodestack.sources.scratch import scratch


def bucketed(frame: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Write rows as a table of the session's catalog, dealt into buckets by a key and sorted in them."""
    name = name or f"bucketed_{uuid.uuid4().hex}"
    frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path or scratch(frame.sparkSession, "bucketed")).saveAsTable(name)
    return frame.sparkSession.table(name)


def bucketed_pair(left: DataFrame, left_key: str, right: DataFrame, right_key: str, buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Two tables with as many buckets, to be joined many times."""
    return bucketed(left, left_key, buckets), bucketed(right, right_key, buckets)
