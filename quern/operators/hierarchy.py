"""Trees as tables of (node, parent): closures and what adds up along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def closure(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """ancestor, descendant, depth for all pairs, each node its own at depth 0.

    Path doubling: rounds grow with the logarithm of the tree's height. A row with a
    null parent is a root; a cycle ends the doubling with an error."""
    nodes = edges.select(F.col(node).alias("ancestor")).union(edges.select(F.col(parent))).where("ancestor is not null").distinct()
    paths = edges.where(F.col(parent).isNotNull()).select(F.col(parent).alias("ancestor"), F.col(node).alias("descendant"), F.lit(1).alias("depth")).distinct()
    reach = 1
    while True:
        up, down = paths.alias("u"), paths.alias("d")
        longer = up.join(down, F.expr("u.descendant = d.ancestor")).select("u.ancestor", "d.descendant", F.expr("u.depth + d.depth").alias("depth"))
        paths = paths.union(longer.where(F.col("depth") > reach)).distinct()
        cycle, deeper = longer.agg(F.max(F.col("ancestor") == F.col("descendant")), F.max(F.col("depth") == 2 * reach)).first()
        if cycle:
            raise ValueError("the tree has a cycle")
        if not deeper:
            break
        reach *= 2
    return nodes.select("ancestor", F.col("ancestor").alias("descendant"), F.lit(0).alias("depth")).union(paths)


def exclusive(nodes: DataFrame, node: str = "node", parent: str = "parent", share: str = "share") -> DataFrame:
    """node, exclusive: a node's share less its children's sum; ok is false below -1e-9."""
    children = nodes.groupBy(F.col(parent).alias("__p")).agg(F.sum(share).alias("__s"))
    out = nodes.join(children, F.col(node) == F.col("__p"), "left")
    value = F.col(share) - F.coalesce(F.col("__s"), F.lit(0.0))
    return out.select(F.col(node), value.alias("exclusive"), (value >= -1e-9).alias("ok"))
