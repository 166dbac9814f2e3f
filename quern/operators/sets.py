"""Unions with guards, set comparisons, lookups with fallbacks, prefix shadowing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEW_ELEMENTS = 1_000_000


def union_of_keys(*parts: DataFrame) -> DataFrame:
    """All rows under all columns, in first-seen order; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, n for keys of several rows: what a union must not have."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: left for keys that only a has, right for those that only b has."""
    x, y = a.select(key).distinct().withColumn("__x", F.lit(1)), b.select(key).distinct().withColumn("__y", F.lit(1))
    j = x.join(y, key, "full")
    return j.where("__x is null or __y is null").select(key, F.when(F.col("__y").isNull(), "left").otherwise("right").alias("side"))


def containment(a: DataFrame, b: DataFrame, key: str, element: str) -> DataFrame:
    """For each key of a and of b that share an element: |A and B| / |A|. By a join on
    the elements of distinct (key, element) rows. Where a has few elements, counted
    first, rows of b without any of them don't shuffle. Null elements are shared with none."""
    x = a.select(F.col(key).alias("a_key"), element).distinct()
    size = x.groupBy("a_key").agg(F.count(F.lit(1)).alias("n"))
    y = b.select(F.col(key).alias("b_key"), element)
    wanted = x.select(F.xxhash64(element).alias("__hash")).distinct()  # 8 bytes each, whatever the elements' length
    if wanted.limit(FEW_ELEMENTS + 1).count() <= FEW_ELEMENTS:
        y = y.join(F.broadcast(wanted), F.xxhash64(element) == F.col("__hash"), "left_semi")
    both = x.join(y.distinct(), element).groupBy("a_key", "b_key").agg(F.count(F.lit(1)).alias("shared"))
    return both.join(size, "a_key").select("a_key", "b_key", "shared", (F.col("shared") / F.col("n")).alias("containment"))


def lookup_chain(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]], into: str) -> DataFrame:
    """The first lookup that has a row's key gives its value. lookups: (table, key of df,
    key of the table, value); table keys are unique. What none resolves stays null."""
    out = df
    for i, (table, key, own, value) in enumerate(lookups):
        t = table.select(F.col(own).alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        out = out.join(t, F.col(key) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    values = [F.col(f"__v{i}") for i in range(len(lookups))]
    return out.withColumn(into, F.coalesce(*values)).drop(*[f"__v{i}" for i in range(len(lookups))])


def require_resolved(df: DataFrame, column: str) -> DataFrame:
    """df, or an error that counts the rows without a value: before anything is written."""
    missing = df.where(F.col(column).isNull()).count()
    if missing:
        raise ValueError(f"{missing} rows without {column}")
    return df


def resolved_or_error(value: Column, what: Column) -> Column:
    """value, or an error that names the row (what) where it is null: the job ends before
    anything is committed, without a pass of its own over the rows."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit("not resolved: "), what)))


def prefix_shadows(df: DataFrame, name: str) -> DataFrame:
    """shadowed, by: names that are a longer name's beginning. Each name's prefixes meet
    the names in an equi-join; the names need not be compared pairwise."""
    names = df.select(F.col(name).alias("by")).distinct()
    prefixes = names.select("by", F.explode(F.when(F.length("by") > 1, F.sequence(F.lit(1), F.length("by") - 1))).alias("n"))
    prefixes = prefixes.select("by", F.expr("substring(by, 1, n)").alias("shadowed"))
    return prefixes.join(names.select(F.col("by").alias("shadowed")), "shadowed")


def majority_flip(df: DataFrame, by: Sequence[str], agree: Column) -> DataFrame:
    """by, agree, disagree, flip: flip where more rows disagree than agree."""
    out = df.groupBy(*by).agg(F.sum(F.when(agree, 1).otherwise(0)).alias("agree"), F.sum(F.when(agree, 0).otherwise(1)).alias("disagree"))
    return out.withColumn("flip", F.col("disagree") > F.col("agree"))


def grid(*axes: DataFrame) -> DataFrame:
    """All combinations of a few axes' values: small, distinct lists."""
    out = axes[0].distinct()
    for a in axes[1:]:
        out = out.crossJoin(F.broadcast(a.distinct()))
    return out


def first_hit(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rn = 1").drop("__rn")


def small(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """df for a join: broadcast if it is counted to have at most `most` (narrow) rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
