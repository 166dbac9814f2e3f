"""Copy numbers along a tree of clones, and what follows from them.

A clone has the copy numbers of the segment nearest to it on its path to the root:
its own if one covers the place, else its parent's, and so on; (1, 1) without any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.folders import written
from .intervals import elementary, point_join


def resolved(segments: DataFrame, closed: DataFrame, width: int = 1000) -> DataFrame:
    """clone, start, end, cn_a, cn_b: what holds along each clone's line, in pieces that don't
    overlap; places without any segment on the line have none.

    segments: clone, start, end, cn_a, cn_b, seg (a total order; of one clone's that overlap
    the later start, then the later seg holds); closed: ancestor, descendant, depth. The
    tree meets the segments, never the places asked for: rows are segments times the clones
    under them, and they are written. Empty segments and null ends hold nowhere."""
    s = segments.join(closed, F.col("clone") == F.col("ancestor")).select(F.col("descendant").alias("clone"), "start", "end", "cn_a", "cn_b", "seg", "depth").where(F.col("end") > F.col("start"))
    pieces = elementary(s, ["clone"]).select("clone", F.col("start").alias("__at"), F.col("end").alias("__until"))
    hit = point_join(pieces, s, ["clone"], "__at", width=width)
    best = hit.groupBy("clone", "__at", "__until").agg(F.min(F.struct("depth", (-F.col("start")).alias("s"), (-F.col("seg")).alias("g"), "cn_a", "cn_b")).alias("b"))
    return written(best.select("clone", F.col("__at").alias("start"), F.col("__until").alias("end"), "b.cn_a", "b.cn_b"), "pieces")


def copies_at(points: DataFrame, segments: DataFrame, closed: DataFrame, key: Sequence[str], width: int = 1000) -> DataFrame:
    """key, clone, cn_a, cn_b for points (key, clone, pos; key and clone name a point once):
    the resolved piece that a point lies in, (1, 1) outside of all. Null clones and places
    are outside."""
    hit = point_join(points, resolved(segments, closed, width), ["clone"], width=width).select(*key, "clone", "cn_a", "cn_b")
    out = points.select(*key, "clone").join(hit, [*key, "clone"], "left")
    one = F.lit(1)
    return out.select(*key, "clone", F.coalesce("cn_a", one).alias("cn_a"), F.coalesce("cn_b", one).alias("cn_b"))


def tiles(pieces: DataFrame, shares: DataFrame, width: int = 1000) -> DataFrame:
    """start, end, copies_a, copies_b, present_a: sums over all clones of share times copies
    (and of the shares of clones that have a copy of a), for the stretches between all cut
    points of resolved pieces; outside of all pieces clones have one copy of each.

    shares: clone, f. Clones without a piece in a stretch aren't joined to it: they are in
    the sum of all shares. Stretches that no piece covers have no row."""
    own = pieces.join(shares, "clone")
    cuts = elementary(pieces.select("start", "end"), []).select(F.col("start").alias("__at"), F.col("end").alias("__until"))
    f = F.col("f")
    sums = point_join(cuts, own, [], "__at", width=width).groupBy("__at", "__until").agg(F.sum(f * (F.col("cn_a") - 1)).alias("a"), F.sum(f * (F.col("cn_b") - 1)).alias("b"), F.sum(F.when(F.col("cn_a") < 1, -f).otherwise(0.0)).alias("p"))
    base = shares.agg(F.sum("f")).scalar()
    return written(sums.select(F.col("__at").alias("start"), F.col("__until").alias("end"), (base + F.col("a")).alias("copies_a"), (base + F.col("b")).alias("copies_b"), (base + F.col("p")).alias("present_a")), "tiles")


def tile_sums(points: DataFrame, key: Sequence[str], tiled: DataFrame, shares: DataFrame, width: int = 1000) -> DataFrame:
    """key, copies_a, copies_b, present_a of the stretch each point (key, pos) lies in: a row
    a point, whatever the number of clones. Outside of all stretches each is the sum of shares."""
    hit = point_join(points.select(*key, "pos"), tiled, [], width=width).select(*key, "copies_a", "copies_b", "present_a")
    base = shares.agg(F.sum("f")).scalar()
    return points.select(*key).join(hit, list(key), "left").select(*key, *[F.coalesce(c, base).alias(c) for c in ("copies_a", "copies_b", "present_a")])


def multiplicity(copies: Column, trunk_before: Column) -> Column:
    """All copies for early events of the trunk, else one where the haplotype is left."""
    return F.when(trunk_before, copies).when(copies >= 1, 1).otherwise(0)


def expected_fraction(purity: float, carried: Column, copies: Column) -> Column:
    """p sum(f m) / (p sum(f (a + b)) + 2 (1 - p)) from the sums over clones."""
    p = F.lit(purity)
    return p * carried / (p * copies + 2 * (1 - p))


def source_plan(df: DataFrame, key: Sequence[str], purity: float) -> DataFrame:
    """key, source, hap, kind, weight: for every clone and haplotype with copies a row
    `all` of weight p f and, beyond one copy, a row `pre_cna` of p f (copies - 1); and
    two rows of the normal, 1 - p each. df: key, clone, f, cn_a, cn_b."""
    p = F.lit(purity)

    def pieces(hap: int, cn: str) -> list[Column]:
        one = F.struct(F.col("clone").alias("source"), F.lit(hap).alias("hap"), F.lit("all").alias("kind"), (p * F.col("f")).alias("weight"), (F.col(cn) > 0).alias("ok"))
        more = F.struct(F.col("clone").alias("source"), F.lit(hap).alias("hap"), F.lit("pre_cna").alias("kind"), (p * F.col("f") * (F.col(cn) - 1)).alias("weight"), (F.col(cn) > 1).alias("ok"))
        return [one, more]

    parts = df.where("f > 0").select(*key, F.explode(F.array(*pieces(0, "cn_a"), *pieces(1, "cn_b"))).alias("x")).where("x.ok")
    normal = df.select(*key).distinct().select(*key, F.explode(F.array(*[F.struct(F.lit("NORMAL").alias("source"), F.lit(h).alias("hap"), F.lit("all").alias("kind"), (1 - p).alias("weight")) for h in (0, 1)])).alias("x"))
    cols = ["x.source", "x.hap", "x.kind", "x.weight"]
    return parts.select(*key, *cols).unionByName(normal.select(*key, *cols))


# The share of the mutated haplotype under an allelic setting; balanced keeps the copies' share.
ALLELIC = {"silenced": 0.1, "dominant": 0.9}


def haplotype_shares(df: DataFrame, keep: Sequence[str], setting: Column, mutant: Column, ploidy: Column) -> DataFrame:
    """keep, hap, share, dosage: how expression splits between haplotypes and scales.

    df: cn_a, cn_b. Shares follow the copies; a setting hands the mutated haplotype (0 or
    1) its fixed share, only where both have copies. Without any copies shares and dosage
    are 0. dosage is the copies over the clone's own ploidy, 1 where that is 0."""
    a, total = F.col("cn_a"), F.col("cn_a") + F.col("cn_b")
    first = F.coalesce(F.try_divide(a, total), F.lit(0.0))
    fixed = F.lit(None).cast("double")
    for name, share in ALLELIC.items():
        fixed = F.when(setting == name, F.lit(share)).otherwise(fixed)
    by_setting = F.when(mutant == 0, fixed).when(mutant == 1, 1 - fixed)
    first = F.when((a > 0) & (F.col("cn_b") > 0), F.coalesce(by_setting, first)).otherwise(first)
    d = df.select(*keep, total.alias("__n"), F.coalesce(F.try_divide(total, ploidy), F.lit(1.0)).alias("dosage"), first.alias("__first"))
    d = d.withColumn("__both", F.array(F.col("__first"), F.when(F.col("__n") > 0, 1 - F.col("__first")).otherwise(0.0)))
    return d.select(*keep, F.posexplode("__both").alias("hap", "share"), "dosage")


def expressed_records(shares: DataFrame, abundance: str, weight: str, length: str, least_length: int, least: float, designed: Column) -> DataFrame:
    """shares (of haplotype_shares, joined with its transcripts and sources) with
    expressed = abundance * dosage * share * weight: transcripts of `least` abundance or
    a designed event, of `least_length`, on haplotypes with a share."""
    d = shares.where(((F.col(abundance) >= least) | designed) & (F.col(length) >= least_length) & (F.col("share") > 0))
    return d.withColumn("expressed", F.col(abundance) * F.col("dosage") * F.col("share") * F.col(weight))


def coverage(depth: float, weight: Column, denominator: Column, factor: Column, least: float = 0.001) -> Column:
    return F.greatest(F.lit(least), F.lit(depth) * weight / denominator * factor)
