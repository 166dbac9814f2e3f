"""Arrays of segments between numbered adapters: their adapters, found in reads or told
by tags, the segments that a read holds, and what adapters look like."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import messagepack as mp
from ..functions.search import best_hits, checked, hits_in
from ..functions.sequence import reverse_complement


def adapter_hits(text: Column, adapters: Sequence[str], edits: int) -> Column:
    """All adapters (labelled by their place in the list) and their reverse complements in
    text, with at most `edits` edits: an array of end, distance, label, turned, by end. Of
    hits of one adapter that overlap the best counts."""
    turn = str.maketrans("ACGTN", "TGCAN")
    kinds = [(label, turned, a[::-1].translate(turn) if turned else a) for label, a in enumerate(adapters) for turned in (False, True)]
    patterns = [a for _, _, a in kinds]
    checked(patterns)

    @F.pandas_udf("array<struct<end:int,distance:int,label:int,turned:boolean>>")
    def found(s: pd.Series) -> pd.Series:
        out = [None] * len(s)
        for i, per in hits_in(s.tolist(), patterns, edits):
            every = sorted((end, distance, label, turned) for (label, turned, a), hits in zip(kinds, per) for end, distance in best_hits(hits, len(a)))
            out[i] = [{"end": e, "distance": d, "label": n, "turned": t} for e, d, n, t in every]
        return pd.Series(out, dtype=object)

    return found(text)


def grammar(hits: Column, last: int) -> Column:
    """What hits of adapters 0 .. last, in order of place, spell: label texts (grammar),
    segments (neighbouring adapters that follow each other), turned and verdict.

    An automaton over the hits: a read of the forward strand must go up by one from hit to
    hit, a turned one down by one; whichever strand has more hits (forward, if equal) is the
    read's. complete: all adapters in order; partial: an unbroken part of them; broken: a
    step that isn't one up (down), or hits of both strands; none: no hits. Null hits give
    null."""
    def read(h: Column) -> Column:
        turned = F.size(F.filter(h, lambda x: x["turned"])) * 2 > F.size(h)
        up = F.when(turned, -1).otherwise(1)

        def walk(direction: Column) -> Column:
            start = F.struct(F.lit(None).cast("int").alias("before"), F.lit(0).alias("segments"), F.lit(True).alias("whole"))

            def step(s: Column, x: Column) -> Column:
                follows = F.coalesce(x["label"] == s["before"] + direction, F.lit(False)) & (x["turned"] == (direction < 0))
                fine = follows | (s["before"].isNull() & (x["turned"] == (direction < 0)))
                return F.struct(x["label"].alias("before"), (s["segments"] + follows.cast("int")).alias("segments"), (s["whole"] & fine).alias("whole"))

            return F.aggregate(h, start, step, lambda s: F.struct(
                F.array_join(F.transform(h, lambda x: F.concat(x["label"].cast("string"), F.when(x["turned"], "-").otherwise("+"))), "").alias("grammar"),
                s["segments"].alias("segments"), (direction < 0).alias("turned"),
                F.when(F.size(h) == 0, "none").when(~s["whole"], "broken").when(s["segments"] == last, "complete").otherwise("partial").alias("verdict")))

        return mp.let(up, walk)

    return mp.let(hits, read)


def segments(df: DataFrame, key: Sequence[str], text: str, hits: str, lengths: Sequence[int]) -> DataFrame:
    """key, segment (label of the adapter before it), sequence in the adapters' own
    direction, for neighbouring hits of one strand that follow each other. lengths: of the
    adapters, taken off from the hits' ends. Letters belong to one adapter: of hits that
    overlap, one that no hit of its strand precedes or follows in order is left out beside
    one that has such a hit."""
    long = lambda x: F.element_at(F.array(*[F.lit(n) for n in lengths]), x["label"] + 1)
    overlap = lambda x, y: (x["end"] > y["end"] - long(y)) & (y["end"] > x["end"] - long(x))

    def next_to(x: Column, y: Column) -> Column:
        step = F.when((y["end"] > x["end"]) == x["turned"], -1).otherwise(1)
        return (y["turned"] == x["turned"]) & (y["label"] == x["label"] + step)

    def apart(h: Column) -> Column:
        told = F.filter(h, lambda x: F.exists(h, lambda y: next_to(x, y)))
        return mp.let(told, lambda t: F.filter(h, lambda x: F.array_contains(t, x) | ~F.exists(t, lambda y: overlap(x, y))))

    crossed = F.exists(F.zip_with(hits, F.slice(hits, F.lit(2), F.greatest(F.size(hits) - 1, F.lit(0))), lambda x, y: overlap(x, y)), lambda b: F.coalesce(b, F.lit(False)))
    df = df.withColumn(hits, F.when((F.size(hits) > 1) & crossed, mp.let(F.col(hits), apart)).otherwise(F.col(hits)))
    size = long(F.col("b"))
    pairs = F.zip_with(F.slice(hits, F.lit(1), F.greatest(F.size(hits) - 1, F.lit(0))), F.slice(hits, F.lit(2), F.greatest(F.size(hits) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    d = df.where(F.size(hits) > 1).select(*key, F.col(text).alias("__t"), F.explode(pairs).alias("p")).select(*key, "__t", "p.a", "p.b")
    follows = (F.col("a.turned") == F.col("b.turned")) & (F.col("b.label") - F.col("a.label") == F.when(F.col("a.turned"), -1).otherwise(1))
    d = d.where(follows).withColumn("s", F.substring("__t", F.col("a.end") + 1, F.greatest(F.col("b.end") - size - F.col("a.end"), F.lit(0))))
    return d.select(*key, F.least("a.label", "b.label").alias("segment"), F.when(F.col("a.turned"), reverse_complement(F.col("s"))).otherwise(F.col("s")).alias("sequence"))


def told_adapters(tags: DataFrame, key: Sequence[str], tag: str) -> DataFrame:
    """key, label, seq: the adapters that MessagePack tags name, each a map with label and
    seq somewhere in the tag. A tag that is cut off gives those before the cut; pairs
    without a label or seq are left out, null tags have none."""
    d = tags.select(*key, F.explode(mp.unpacked(F.col(tag))["values"]).alias("v")).select(*key, "v.path", "v.text").where("text is not null")
    name, over = F.regexp_extract("path", r"([^.]*)$", 1), F.regexp_extract("path", r"^(.*?)\.?[^.]*$", 1)
    d = d.select(*key, over.alias("__at"), name.alias("__name"), "text").where(F.col("__name").isin("label", "seq"))
    pick = lambda n: F.max(F.when(F.col("__name") == n, F.col("text"))).alias(n)
    return d.groupBy(*key, "__at").agg(pick("label"), pick("seq")).where("label is not null and seq is not null").select(*key, "label", "seq")


def consensus(observed: DataFrame, label: str = "label", seq: str = "seq") -> DataFrame:
    """label, seq (place by place the most frequent letter, the first of equals), length
    (the most frequent one, the shortest of equals), n (observations of that length) and
    worst (the least share of a consensus letter in its place). Observations are counted
    before they are cut into letters; empty ones and nulls are left out."""
    counted = observed.where(F.length(seq) > 0).groupBy(label, seq).agg(F.count(F.lit(1)).alias("c"))
    sizes = counted.groupBy(label, F.length(seq).alias("length")).agg(F.sum("c").alias("n"))
    modal = sizes.groupBy(label).agg(F.min(F.struct((-F.col("n")).alias("n"), "length")).alias("m")).select(label, F.col("m.length").alias("length"), (-F.col("m.n")).alias("n"))
    full = counted.join(modal, label).where(F.length(seq) == F.col("length"))
    letters = full.select(label, "c", F.posexplode(F.filter(F.split(seq, ""), lambda x: x != "")).alias("i", "letter")).groupBy(label, "i", "letter").agg(F.sum("c").alias("c"))
    best = letters.groupBy(label, "i").agg(F.min(F.struct((-F.col("c")).alias("c"), "letter")).alias("b"), F.sum("c").alias("total"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("b.letter").alias("x")))), lambda s: s["x"]), "")  # one entry a place
    out = best.groupBy(label).agg(joined.alias("seq"), F.min(-F.col("b.c") / F.col("total")).alias("worst"))
    return out.join(modal, label).select(label, "seq", "length", "n", "worst")


def array_yield(found: DataFrame, array: str, order: str) -> DataFrame:
    """segments, arrays, share: how many arrays have how many segments, without the first and
    the last array in the stream (by the least `order` of their segments): those are cut."""
    per = found.groupBy(array).agg(F.count(F.lit(1)).alias("segments"), F.min(order).alias("__first"))
    ends = per.agg(F.min("__first").alias("__low"), F.max("__first").alias("__high")).withColumn("__one", F.lit(1))
    inner = per.withColumn("__one", F.lit(1)).join(F.broadcast(ends), "__one").where((F.col("__first") != F.col("__low")) & (F.col("__first") != F.col("__high")))
    counts = inner.groupBy("segments").agg(F.count(F.lit(1)).alias("arrays"))
    return counts.withColumn("share", F.col("arrays") / F.sum("arrays").over(Window.partitionBy(F.lit(0))))  # a row a size
