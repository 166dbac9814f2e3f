"""Connected components, and neighbours in a distributed sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, sized


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node of edges (two long columns): root is the smallest
    node that links lead to.

    Large-star and small-star rounds, each a partial minimum and a join, written to
    the shared folder, until all that is left is stars; edges never come to the
    driver, only their number. No edges give no rows.
    """
    spark = edges.sparkSession
    now = materialize(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "edges")
    n = now.count()
    while n:
        both = now.union(now.select("v", "u"))
        low = sized(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), 2 * n)
        # Large star: larger neighbours move to the smallest of a node's neighbourhood.
        large = sized(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), 2 * n)
        large = sized(large.distinct(), n)
        # Small star: smaller neighbours, and the node itself, move to the smallest.
        low = sized(large.groupBy("u").agg(F.min("v").alias("m")), n)
        small = sized(large.join(low, "u"), n)
        now = materialize(sized(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct(), n), "edges")
        # Stars: no node has two smaller neighbours, or a smaller and a larger one.
        n = now.count()
        sides = now.select(F.col("u").alias("node"), F.col("v").alias("root"), F.lit(1).alias("up")).union(now.select("v", "v", F.lit(0)))
        stars = sides.groupBy("node").agg(F.min("root").alias("root"), F.sum("up").alias("ups"), F.min("up").alias("least"))
        stars = materialize(sized(stars, 2 * n), "stars")
        if stars.where("ups > 1 or ups = 1 and least = 0").isEmpty():
            return stars.select("node", "root")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root by the links of `roots` (node, root as components gives them) and by
    further ones (a, b). Only the roots that these join go through rounds again."""
    n, old = links.count(), roots.count()
    if not n:
        return roots
    if not old:
        return components(links)
    known = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    ends = links.select("a", "b")
    for side in ("a", "b"):
        ends = sized(ends.join(known, F.col(side) == F.col("__n"), "left").withColumn(side, F.coalesce("__r", side)).select("a", "b"), old + n)
    joined = components(ends).select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    moved = roots.join(joined, F.col("root") == F.col("__n"), "left").select("node", F.coalesce("__r", "root").alias("root"))
    new = joined.join(roots.select("node"), F.col("__n") == F.col("node"), "left_anti").select(F.col("__n").alias("node"), F.col("__r").alias("root"))
    return materialize(sized(moved, old + n).union(sized(new, old + n)), "roots")
