"""Structured Streaming counterparts of bounded scans; extensions, not asked for by the
tables' own operators. Each takes and returns a streaming (or plain) DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """New text files of a folder, some at a time, as lines with their file and its time."""
    d = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(path)
    return d.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("time"))


def distinct_names(df: DataFrame, keys: Sequence[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are forgotten after the delay."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def rate(df: DataFrame, time: str, window: str = "1 second", by: Sequence[str] = (), delay: str = "1 minute") -> DataFrame:
    """Rows a window (and key), late rows up to the delay included."""
    out = df.withWatermark(time, delay).groupBy(F.window(time, window), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def paired(a: DataFrame, b: DataFrame, key: str, time: str, within: str = "1 minute") -> DataFrame:
    """Rows of two streams with the same ordinal key whose times are close."""
    x, y = a.withWatermark(time, within).alias("x"), b.withWatermark(time, within).alias("y")
    near = f"x.{key} = y.{key} and y.{time} between x.{time} - interval {within} and x.{time} + interval {within}"
    return x.join(y, F.expr(near))


def late(df: DataFrame, time: str, against: str, delay_hours: float) -> DataFrame:
    """lag in hours between two times, and whether it is within the delay."""
    lag = (F.unix_timestamp(against) - F.unix_timestamp(time)) / 3600.0
    return df.withColumn("lag_hours", lag).withColumn("verdict", F.when(lag.isNull(), "FAIL (nothing measured)").when(lag <= delay_hours, "PASS").otherwise("FAIL (late)"))
