"""Places that the driver and all executors share, and tables written there."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where it is unset (a local session, as in tests), a temporary folder takes its place, as driver and
    executors are then one process.  On a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Batches of the jobs that `materialise` starts, in Arrow and of the Parquet reader: small, as rows may be whole texts.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Settings for the jobs inside; afterwards the session has its own again."""
    before = {k: spark.conf.get(k) for k in BATCHES}
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def trimmed(work: Callable) -> Callable:
    """A function for mapInArrow that gives freed memory back when its partition ends: idle workers stay alive."""

    def run(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow

        try:
            yield from work(batches)
        finally:
            pyarrow.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return run


def give_back(spark: SparkSession) -> None:
    """Have the executors collect their garbage, which also shrinks their heaps.

    A heap that short-lived pages and batches have made grow stays as large for long, and stands beside the Python workers."""
    from pyspark.sql import functions as F

    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them again: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    with small_batches(spark):
        frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.written_to = path
    return out


#: Rows and bytes (in its Parquet files) of a join's side that may go to all executors.
MOST_SENT_ROWS, MOST_SENT_BYTES = 500_000, 16 << 20


def small_side(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written; with the hint to send them to all executors if they are few enough, counted and weighed.

    Joins of texts with a short list then need no exchange of the texts; with a long list both sides are dealt."""
    from pyspark.sql import functions as F

    spark = frame.sparkSession
    path = fresh_path(spark, name)
    with small_batches(spark):
        frame.write.parquet(path)
    written = spark.read.schema(frame.schema).parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()
    return F.broadcast(written) if size <= MOST_SENT_BYTES and written.count() <= MOST_SENT_ROWS else written


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop(*frames: DataFrame) -> None:
    """Delete what `materialise` and `small_side` wrote for these frames: nothing must read them any more."""
    for frame in frames:
        if (path := getattr(frame, "written_to", None)) is not None:
            delete(frame.sparkSession, path)


@contextlib.contextmanager
def local_filesystem(uri: str) -> Iterator[tuple[Any, str]]:
    """The file system and path of a URI, opened in an executor's Python."""
    from pyarrow import fs

    yield (fs.LocalFileSystem(), uri) if "://" not in uri and not uri.startswith("file:") else fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def column_or_null(frame: DataFrame, name: str, kind: str):
    """The column, cast, or nulls where the table lacks it."""
    from pyspark.sql import functions as F

    return frame[name].cast(kind).alias(name) if name in frame.columns else F.lit(None).cast(kind).alias(name)
