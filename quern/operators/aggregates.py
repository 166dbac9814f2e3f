"""Aggregates: many frequency tables at once, pooled ratios, nearest-rank percentiles,
binned curves, arg-min and arg-max with payloads and explicit ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import cigar_sum


def frequency_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, key, n: one count table for each column, in a single pass and shuffle."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("key")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.field", "p.key").agg(F.count(F.lit(1)).alias("n"))


def pooled_ratio(df: DataFrame, by: Sequence[str], part: str, total: str, expected: str) -> DataFrame:
    """Per group: sum(part) / sum(total) against sum(expected * total) / sum(total), the
    relative sampling error sigma, the relative deviation and the bound max(3 sigma, 0.1)."""
    out = df.groupBy(*by).agg((F.sum(part) / F.sum(total)).alias("observed"), (F.sum(F.col(expected) * F.col(total)) / F.sum(total)).alias("expected"), F.sum(total).alias("total"))
    e = F.col("expected")
    out = out.withColumn("sigma", F.sqrt(F.greatest(e * (1 - e) / F.col("total"), F.lit(1e-12))) / e)
    return out.withColumn("deviation", F.abs(F.col("observed") - e) / e).withColumn("bound", F.greatest(3 * F.col("sigma"), F.lit(0.10)))


def nearest_rank(values: Column, p: float) -> Column:
    """The element of a group at index min(n - 1, floor(p * n)) of its sorted values."""
    ordered = F.array_sort(F.collect_list(values))
    return F.element_at(ordered, (F.least(F.size(ordered) - 1, F.floor(F.size(ordered) * p)) + 1).cast("int"))


def nearest_rank_large(df: DataFrame, by: Sequence[str], value: str, ps: Sequence[float]) -> DataFrame:
    """nearest_rank for groups of any size: distinct values are counted first, and the
    ranks come from running sums of these counts."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by)
    ranked = counts.withColumn("__to", F.sum("__n").over(w.orderBy(value))).withColumn("__all", F.sum("__n").over(w))
    at = [F.least(F.col("__all") - 1, F.floor(F.col("__all") * F.lit(p))) for p in ps]
    return ranked.groupBy(*by).agg(*[F.min(F.when(F.col("__to") > i, F.col(value))).alias(f"p{round(p * 100)}") for p, i in zip(ps, at)])


def arg_best(df: DataFrame, by: Sequence[str], order: Sequence[Column], payload: Sequence[str]) -> DataFrame:
    """The payload of each group's first row in order; order must be total."""
    best = F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(p) for p in payload])).alias("__best")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"__best.{p}").alias(p) for p in payload])


def empirical_cdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """value, n, cdf: share of rows at or below each value."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # distinct values only
    return counts.withColumn("cdf", F.sum("n").over(w.orderBy(value)) / F.sum("n").over(w))


def binned_factor(df: DataFrame, bin_: Column, value: str) -> DataFrame:
    """bin, n, factor: the bin's mean relative to the whole mean, scaled so that the
    factors' mean weighted by n is 1."""
    b = df.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    w = Window.partitionBy(F.lit(0))  # bins only
    b = b.withColumn("ratio", (F.col("s") / F.col("n")) / (F.sum("s").over(w) / F.sum("n").over(w)))
    return b.select("bin", "n", (F.col("ratio") / (F.sum(F.col("ratio") * F.col("n")).over(w) / F.sum("n").over(w))).alias("factor"))


def density_ratio(a: DataFrame, b: DataFrame, bin_: Column, cap: float) -> DataFrame:
    """bin, ratio: share of a's rows over share of b's, at most cap, scaled to a mean of
    1 weighted by b's rows; bins that b lacks have none."""
    x = a.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("x"))
    y = b.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("y"))
    w = Window.partitionBy(F.lit(0))  # bins only
    j = y.join(x, "bin", "left").withColumn("x", F.coalesce("x", F.lit(0)))
    j = j.withColumn("raw", F.least(F.lit(cap), (F.col("x") / F.sum("x").over(w)) / (F.col("y") / F.sum("y").over(w))))
    return j.select("bin", (F.col("raw") / (F.sum(F.col("raw") * F.col("y")).over(w) / F.sum("y").over(w))).alias("ratio"))


def rescale_to_budget(df: DataFrame, by: Sequence[str], value: str, budget: DataFrame, budget_col: str) -> DataFrame:
    """Rows with value times min(1, budget / the group's sum) as scaled; a group without
    a budget keeps its values, a group that sums to 0 gets 0."""
    have = df.groupBy(*by).agg(F.sum(value).alias("__have"))
    factor = have.join(budget, list(by), "left").withColumn("factor", F.when(F.col("__have") == 0, 0.0).when(F.col(budget_col).isNull(), 1.0).otherwise(F.least(F.lit(1.0), F.col(budget_col) / F.col("__have"))))
    return df.join(factor.select(*by, "factor"), list(by)).withColumn("scaled", F.col(value) * F.col("factor"))


def shares(value: str, by: Sequence[str] = ()) -> Column:
    """A row's part of its group's sum; without `by` of the whole, for tables of groups."""
    return F.col(value) / F.sum(value).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))


def middle(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """by, name: the median of each group, from counts of its distinct values: a row a value
    meets the others of its group. Null values don't count; a group of them has no row."""
    c = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by)
    upto = F.sum("__n").over(w.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("__upto", upto).withColumn("__all", F.sum("__n").over(w))
    # Places (all - 1) // 2 and all // 2, from 0: the same one of an odd number.
    low, high = F.floor((F.col("__all") - 1) / 2), F.floor(F.col("__all") / 2)
    holds = lambda at: (at < F.col("__upto")) & (at >= F.col("__upto") - F.col("__n"))
    return c.groupBy(*by).agg(((F.max(F.when(holds(low), F.col("__v"))) + F.max(F.when(holds(high), F.col("__v")))) / 2).alias(name))


def pass_counts(df: DataFrame, by: Sequence[str], np: str, ec: str) -> DataFrame:
    """by, reads, np_mean, np_median, ec_over_np (the median ratio): of reads with a number
    of passes; those without coverage, or with none, don't count in the ratio."""
    d = df.where(F.col(np) > 0)
    head = d.groupBy(*by).agg(F.count(F.lit(1)).alias("reads"), F.avg(np).alias("np_mean"))
    ratio = d.where(F.col(ec) != 0).withColumn("__ratio", F.col(ec) / F.col(np))
    return head.join(middle(d, by, np, "np_median"), list(by), "left").join(middle(ratio, by, "__ratio", "ec_over_np"), list(by), "left")


def alignment_identity(df: DataFrame, by: Sequence[str], cigar: str, nm: str, quality: str) -> DataFrame:
    """One row a group of primary alignments: reads, aligned, clipped_fraction, nm,
    inserted, deleted, true_identity (1 - nm / aligned), claimed_identity (from the mean
    error probability of all qualities, converted once), indel_fraction (of nm), ratio of
    true to claimed error. Divisions by nothing are null; null qualities don't count."""
    errors = F.aggregate(F.transform(F.filter(F.split(F.col(quality), ""), lambda c: c != ""), lambda c: F.pow(F.lit(10.0), -(F.ascii(c) - 33) / 10.0)), F.lit(0.0), lambda a, x: a + x)
    one = lambda ops: F.sum(cigar_sum(F.col(cigar), ops))
    filled = F.length(quality) > 0
    d = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("reads"), one("M=XID").alias("aligned"), one("SH").alias("clipped"), F.sum(nm).alias("nm"), one("I").alias("inserted"), one("D").alias("deleted"),
        F.sum(F.when(filled, errors)).alias("__q"), F.sum(F.when(filled, F.length(quality))).alias("__bases"))
    true, claimed = F.try_divide("nm", "aligned"), F.try_divide("__q", "__bases")
    return d.select(
        *by, "reads", "aligned", F.try_divide("clipped", F.col("aligned") + F.col("clipped")).alias("clipped_fraction"), "nm", "inserted", "deleted", (1 - true).alias("true_identity"), (1 - claimed).alias("claimed_identity"),
        F.try_divide(F.col("inserted") + F.col("deleted"), F.col("nm")).alias("indel_fraction"), F.try_divide(true, claimed).alias("ratio"))
