"""Folders that all executors share, tables written there, and Arrow batch limits."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20
TASK_ROWS = 20_000  # of a few numbers each
_OWN: list[str] = []
_RECORDS: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where a session has none a temporary
    folder is made, on one machine only: on a cluster executors would not share it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="quern-shared-"))
    return _OWN[0]


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/quern-{what}-{uuid.uuid4().hex[:12]}"
    for record in _RECORDS:
        record.append(path)
    return path


@contextlib.contextmanager
def recording():
    """A list that gets every path of the shared folder that new_path gives meanwhile."""
    record: list[str] = []
    _RECORDS.append(record)
    try:
        yield record
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not record]


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: this cuts the
    lineage, and what was written outlives any executor."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def leaving(spark: SparkSession):
    """Deletes, at its end, the paths that new_path gave meanwhile, but for those added
    to the set that it yields: tables that nothing reads any more don't fill the disk."""
    kept: set[str] = set()
    with recording() as record:
        yield kept
    for path in record:
        if path not in kept:
            remove(spark, path)


def small_batches(spark: SparkSession) -> None:
    """Python workers get at most ARROW_ROWS rows or ARROW_BYTES (and one row) at once,
    so that rows with long texts fit in their memory."""
    for key, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        now = re.fullmatch(r"(\d+)b?", spark.conf.get(f"spark.sql.execution.arrow.{key}"))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def trimmed(run):
    """run (a function of Arrow batches) that gives freed memory back to the system at
    its end: Python workers stay alive, idle, beside the next stage's."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # no glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """df, the result of a shuffle of about so many rows, counted before: one task for
    `each` of them, at least one a core. Small tables don't pay for as many tasks as
    the large ones need; from `each` rows a partition on nothing changes."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, math.ceil(rows / each))
    return df.coalesce(n) if n < partitions(spark) else df
