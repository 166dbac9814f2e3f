"""Numbering, apportionment, interleaving and first-wins choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "rn", by: Sequence[str] = (), buckets: Column | None = None) -> DataFrame:
    """Row numbers from 1 by order (in each group of `by`). `buckets`, a column that never
    falls as order rises, splits the sort: counts per bucket give each one's offset, so
    the rows of a group need not meet in one task."""
    if buckets is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    d = df.withColumn("__b", buckets)
    sizes = d.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__b").alias("__c"), before.alias("__off"))
    d = d.withColumn("__r", F.row_number().over(Window.partitionBy(*by, "__b").orderBy(*order)))
    cond = F.col("__b").eqNullSafe(F.col("__c"))
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return d.join(sizes, cond).withColumn(name, F.col("__r") + F.col("__off")).drop("__b", "__c", "__r", "__off", *[f"__by_{c}" for c in by])


def first_wins(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key; order must be total."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rn = 1").drop("__rn")


def floor_then_fill(df: DataFrame, by: Sequence[str], order: Sequence[Column], floor: int, total: int) -> DataFrame:
    """The best `floor` rows of each class, then the best of all others up to `total` rows.

    Only the first `total` rows of each class can be chosen, so no more reach the last sort."""
    d = df.withColumn("class_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("class_rank") <= max(floor, total))
    late = (F.col("class_rank") > floor).cast("int")
    return d.withColumn("pick", F.row_number().over(Window.orderBy(late, *order))).where((F.col("pick") <= total) | (late == 0))


def prefer_subset(df: DataFrame, by: Sequence[str], preferred: Column, order: Sequence[Column], n: int) -> DataFrame:
    """n rows a group: up to (n + 1) // 2 preferred ones first, then the best of the rest."""
    w = Window.partitionBy(*by)
    d = df.withColumn("__p", preferred).withColumn("__k", F.row_number().over(Window.partitionBy(*by, preferred).orderBy(*order)))
    early = F.when(F.col("__p") & (F.col("__k") <= (n + 1) // 2), 0).otherwise(1)
    return d.withColumn("pick", F.row_number().over(w.orderBy(early, *order))).where(F.col("pick") <= n).drop("__p", "__k")


def apportion(df: DataFrame, weight: str, seats: int, tie: Sequence[Column | str]) -> DataFrame:
    """Largest remainders: seats in proportion to weight, summing to seats exactly. For
    tables of groups, which are small."""
    w = Window.partitionBy(F.lit(0))
    exact = F.col(weight) * seats / F.sum(weight).over(w)
    d = df.withColumn("__exact", exact).withColumn("__base", F.floor("__exact"))
    d = d.withColumn("__rank", F.row_number().over(w.orderBy((F.col("__exact") - F.col("__base")).desc(), *tie))).withColumn("__left", F.lit(seats) - F.sum("__base").over(w))
    return d.withColumn("seats", F.col("__base") + F.when(F.col("__rank") <= F.col("__left"), 1).otherwise(0)).drop("__exact", "__base", "__rank", "__left")


def interleave(df: DataFrame, source: str, order: Sequence[Column | str], buckets: Column | None = None, cells: int = 1024) -> DataFrame:
    """Merge sources so that each step takes from the one with the largest remaining
    fraction: a row's turn is (its number - 1) / its source's count, ties to the
    lesser source. Adds turn and the place in the merge, `slot`. `buckets` as in
    numbered: without it a source is numbered in one task. The merge is sorted in `cells` parts."""
    sizes = df.groupBy(F.col(source).alias("__of")).agg(F.count(F.lit(1)).alias("__n"))  # a row a source
    d = numbered(df, order, "__rn", [source], buckets).join(sizes, F.col(source).eqNullSafe(F.col("__of")))
    d = d.withColumn("turn", (F.col("__rn") - 1) / F.col("__n"))
    return numbered(d, ["turn", source], "slot", buckets=F.floor(F.col("turn") * cells)).drop("__rn", "__n", "__of")


def ordinals(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    return numbered(df, order, "ordinal", by)


def lockstep(a: DataFrame, b: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Rows of equal ordinal side by side, both sides kept: ordinal, left and right name,
    status: paired, name differs, left exhausted, right exhausted."""
    x = a.select(*by, "ordinal", F.col(name).alias("left_name"), F.lit(True).alias("__l"))
    y = b.select(*by, "ordinal", F.col(name).alias("right_name"), F.lit(True).alias("__r"))
    j = x.join(y, [*by, "ordinal"], "full")
    status = F.when(F.col("__l").isNull(), "left exhausted").when(F.col("__r").isNull(), "right exhausted").when(F.col("left_name").eqNullSafe(F.col("right_name")), "paired").otherwise("name differs")
    return j.withColumn("status", status).drop("__l", "__r")


def runs_of_equal(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], state: str) -> DataFrame:
    """Maximal runs of equal state: by, state, run, n."""
    w = Window.partitionBy(*by).orderBy(*order)
    d = df.withColumn("__new", F.when(F.lag(state).over(w).eqNullSafe(F.col(state)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    return d.withColumn("run", F.sum("__new").over(w)).groupBy(*by, state, "run").agg(F.count(F.lit(1)).alias("n"))


def packed(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], size: Column, most: int, block: int = 1 << 16, buckets: Column | None = None) -> DataFrame:
    """Rows in order put into arrays of drawn sizes: adds array and member (both from 0).

    size is a column of by, __block and array, the number of rows that an array takes,
    held between 1 and `most`; the last one takes what is left. Arrays are filled inside of
    blocks of `block` rows and array counts on from block to block by `block`, so that a
    group need not meet in one task; `buckets` as in numbered does the same for its order."""
    d = numbered(df, order, "__rn", by, buckets).withColumn("__at", F.col("__rn") - 1)
    d = d.withColumn("__block", F.floor(F.col("__at") / block)).withColumn("__at", F.col("__at") % block)
    sizes = d.groupBy(*by, "__block").agg(F.count(F.lit(1)).alias("__n"))
    a = sizes.withColumn("array", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    a = a.withColumn("__size", F.least(F.greatest(size, F.lit(1)), F.lit(most)).cast("long"))
    upto = F.sum("__size").over(Window.partitionBy(*by, "__block").orderBy("array").rowsBetween(Window.unboundedPreceding, 0))
    a = a.withColumn("__first", upto - F.col("__size")).where("__first < __n").withColumn("__at", F.explode(F.sequence(F.col("__first"), F.least(F.col("__first") + F.col("__size"), F.col("__n")) - 1)))
    a = a.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__block").alias("__b"), F.col("__at").alias("__to"), "array", (F.col("__at") - F.col("__first")).alias("member"))
    cond = (F.col("__block") == F.col("__b")) & (F.col("__at") == F.col("__to"))
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    out = d.join(a, cond).withColumn("array", F.col("__block") * block + F.col("array"))
    return out.drop("__rn", "__at", "__block", "__b", "__to", *[f"__by_{c}" for c in by])
