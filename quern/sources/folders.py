"""A folder that the driver and all executors share, for files that a query writes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A new path under the folder that spark.checkpoint.dir names. Where it is unset
    a temporary folder serves a session on one machine; a cluster is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="quern-files-"))
        shared = _OWN[0]
    return f"{shared.rstrip('/')}/quern-{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as Parquet files in a new folder, read again: later plans start from the files,
    which outlive any executor."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
