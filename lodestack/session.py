"""The Spark session that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What results depend on.
SEMANTICS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
#: What plans depend on: runtime re-planning, statistics, runtime filters.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "lodestack", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` (with `__` for dots) goes on top."""
    builder = SparkSession.builder.appName(name).config(map={**SEMANTICS, **PLANNING, **{k.replace("__", "."): v for k, v in conf.items()}})
    return (builder.master(master) if master else builder).getOrCreate()
