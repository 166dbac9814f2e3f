"""All registered queries and their SQL. Plan modules add theirs with @query."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "d31_truth_fraction"
MODULES = ("interval_plans", "aggregate_plans", "window_plans", "join_plans", "sampling_plans", "scalar_plans", "scans", "projections", "domain_plans", "genome_plans", "check_plans", "calibration_plans", "assay_plans")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder by name: t.orders, t.lineitem, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register f(t) as a query under its name, with SQL for the same rows."""

    def add(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def load() -> None:
    for m in MODULES:
        import_module(f"quern.plans.{m}")
