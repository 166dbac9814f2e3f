"""Rows of a table over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame) -> DataFrame:
    """df in a few parts a core: a table of a few megabytes is one part, however much its rows cost."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
