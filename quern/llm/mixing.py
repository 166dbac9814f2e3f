"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws a uniform number from its id and turns it into an exponential
key scaled by its quality weight: key = -ln(u) / weight. Within a source, documents
in key order are prefix-summed to the source's budget. A budget above the source's
size first takes every document as often as it wholly fits (complete epochs); only
the rest is a selection. The prefix sums are taken in three levels (source, slice of
the keys' range, document), so no source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
ROWS_A_CELL = 256  # rows for each cell that a unit of log(key) is cut into
MAX_CELLS = 1 << 14


def word_count(text: Column) -> Column:
    """Longest runs without white space of ASCII; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """The square of the share of letters (ASCII ones, and all characters beyond ASCII)
    in the characters that are not white space, 0.01 at least: prose of any script is
    near 1, tables, markup and junk draw late. It does not depend on spaces."""
    seen = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    share = F.coalesce(letters, F.lit(0)).cast("double") / F.greatest(F.coalesce(seen, F.lit(0)), F.lit(1)).cast("double")
    return F.greatest(F.lit(0.01), share * share)


def uniform(key: Column, seed: int) -> Column:
    """A number within 0 and 1, both excluded, of 48 bits of an md5."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12), 16, 10)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """sizes (source, source_size), a row for each source, with target.

    Sources in code-point order, null last, get the weights in turn. Targets are in
    proportion to the weights and sum to share times all sizes; a target stops at
    most times its source's size and the excess goes to the others by weight, until
    none is above. That is target = min(cap, level * weight); the level follows from
    prefix sums over sources in order of cap / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), k.cast("int") + 1)
    s = sizes.withColumn("__w", w).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    s = s.withColumn("__all", F.sum("source_size").over(every) * F.lit(float(share)))
    s = s.withColumn("__caps", F.coalesce(F.sum("__cap").over(by_ratio), F.lit(0.0)))
    s = s.withColumn("__left", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(by_ratio), F.lit(0.0)))
    s = s.withColumn("__level", (F.col("__all") - F.col("__caps")) / F.col("__left"))
    # The level is that of the first source, in this order, that it does not cap; later ones give less.
    s = s.withColumn("__fits", F.when(F.col("__level") * F.col("__w") <= F.col("__cap"), F.col("__level")))
    level = F.max("__fits").over(every)
    return s.select("source", "source_size", F.least(F.col("__cap"), F.coalesce(level * F.col("__w"), F.col("__cap"))).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, draw_col: str | None = None) -> DataFrame:
    """One row for each row of df: id_col, size, source_size, target, taken, epochs,
    part, weight.

    size: words of the text. taken = epochs * size + part: epochs whole copies and,
    of the sampled documents, part = size, but less for the one on which the budget
    ends. Keys are drawn from draw_col, by default the id. A null text is empty and
    has size 0; null is a source of its own, the last one; a null id draws like an
    empty one; rows with equal keys go by id, then by size: rows that share all three
    are alike here, so the rows returned do not depend on how a table is split. No
    rows give none. Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), text.alias("__text"), F.col(draw_col or id_col).alias("draw"))
    rows = rows.withColumn("weight", quality_weight(F.col("__text"))).drop("__text")
    rows = rows.withColumn("key", -F.log(uniform(F.col("draw"), seed)) / F.col("weight")).withColumn("row", F.monotonically_increasing_id()).drop("draw")
    rows = materialize(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = materialize(source_targets(sizes.select("source", "source_size"), weights, share, most), "targets")
    # Slices are as wide as each other in log(key). Of keys with one weight, whatever it is, a unit
    # of log(key) has e**-1 at most, so the largest slice has 0.37 / cells of a source's rows.
    cells = max(1, min(MAX_CELLS, rows.count() // ROWS_A_CELL))
    rows = rows.withColumn("slice", F.floor(F.log("key") * cells).cast("int"))
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0).cast("long"))).drop("words")
    t, b = targets.alias("t"), sums.alias("b")
    within = Window.partitionBy("source", "slice").orderBy("key", F.col("id").asc_nulls_first(), "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long"))).alias("r")
    # A source of a third of all rows has thousands of (source, slice) pairs: no hot key.
    rows = rows.join(b, F.expr("r.source <=> b.source and r.slice = b.slice"), "left")
    rows = rows.join(F.broadcast(t) if targets.count() <= 100_000 else t, F.expr("r.source <=> t.source"), "left")
    epochs = F.coalesce(F.floor(F.col("target") / F.col("source_size")), F.lit(0)).cast("long")
    rest = F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size") - F.col("base") - F.col("ahead")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    out = rows.withColumn("epochs", F.when(F.col("source_size") > 0, epochs).otherwise(F.lit(0).cast("long"))).withColumn("part", part)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part", "weight")
