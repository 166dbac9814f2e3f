"""Timestamps as whole numbers, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600_000_000


def micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def days(column: str) -> Column:
    return F.expr(f"cast(datediff(cast({column} as date), date'1970-01-01') as long)")
