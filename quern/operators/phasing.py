"""Haplotypes: which one an allele lies on, edits of both as records, and the phase of
records from a panel, from blocks of reads and by draw.

Places count from 0 and spans are half-open unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messagepack import let
from ..functions.sequence import reverse_complement
from ..sources.folders import written
from .genome import fetched
from .intervals import islands, point_join
from .sampling import uniform


def canonical_kmers(df: DataFrame, key: Sequence[str], seq: str, k: int) -> DataFrame:
    """key, kmer: 64-bit hashes of the distinct k-letter parts of A, C, G and T, a part and its
    reverse complement being one (the lesser of both stands for them). Shorter texts, nulls
    and parts with other letters have none. A row a part: no text's parts meet in one value."""
    s = F.upper(seq)
    at = F.sequence(F.lit(1), F.length(s) - k + 1)
    d = df.where(F.length(seq) >= k).select(*key, F.explode(F.transform(at, lambda i: F.substring(s, i, F.lit(k)))).alias("__part")).where(F.col("__part").rlike("^[ACGT]+$"))
    return d.select(*key, F.xxhash64(F.least("__part", reverse_complement(F.col("__part")))).alias("kmer")).distinct()


def phase_by_containment(alleles: DataFrame, sides: DataFrame, k: int, margin: float = 0.02) -> DataFrame:
    """locus, allele, declared, hap0, hap1 (shares of the allele's k-mers that the locus's
    haplotype has, on either strand), measured, status.

    alleles: locus, allele, declared (0 or 1), seq; sides: locus, hap (0 or 1), seq, both
    haplotypes of a locus. status: homozygous where a locus has one allele only (nothing is
    measured), no sequence where the allele's is null, no allelic difference where both
    haplotypes are the same text (so neither allele can lie on one), indeterminate where the
    shares differ by less than margin, else ok or INVERTED. An allele declared on both sides
    comes as two rows of equal text; it counts once and is declared on either. Alleles
    without k-mers have shares of 0; loci without sides too. K-mers and loci are merged, not
    broadcast: the size of the tables read doesn't tell how many they become."""
    per = alleles.groupBy("locus", "allele").agg(F.max("seq").alias("seq"), F.collect_set("declared").alias("on"))
    count = per.groupBy("locus").agg(F.count(F.lit(1)).alias("n"))
    wanted = per.join(count.hint("merge"), "locus")
    tested = wanted.where("n > 1 and seq is not null")
    mine = canonical_kmers(tested, ["locus", "allele"], "seq", k)
    theirs = canonical_kmers(sides, ["locus", "hap"], "seq", k).groupBy("locus", "kmer").agg(F.bool_or(F.col("hap") == 0).alias("in0"), F.bool_or(F.col("hap") == 1).alias("in1"))
    shares = mine.join(theirs.hint("merge"), ["locus", "kmer"], "left").groupBy("locus", "allele").agg((F.count_if("in0") / F.count(F.lit(1))).alias("hap0"), (F.count_if("in1") / F.count(F.lit(1))).alias("hap1"))
    alike = sides.groupBy("locus").agg((F.count_distinct(F.sha2("seq", 256)) == 1).alias("alike"))
    d = wanted.join(shares.hint("merge"), ["locus", "allele"], "left").join(alike.hint("merge"), "locus", "left")
    known = (F.col("n") > 1) & F.col("seq").isNotNull()
    share = lambda c: F.when(known, F.coalesce(c, F.lit(0.0)))
    d = d.withColumn("hap0", share("hap0")).withColumn("hap1", share("hap1"))
    clear = known & ~F.coalesce("alike", F.lit(False)) & (F.abs(F.col("hap0") - F.col("hap1")) >= margin)
    d = d.withColumn("measured", F.when(clear, (F.col("hap0") < F.col("hap1")).cast("int")))
    status = F.when(F.col("n") == 1, "homozygous").when(F.col("seq").isNull(), "no sequence").when(F.coalesce("alike", F.lit(False)), "no allelic difference").when(F.col("measured").isNull(), "indeterminate").when(F.array_contains("on", F.col("measured")), "ok").otherwise("INVERTED")
    return d.select("locus", "allele", F.array_join(F.array_sort(F.transform("on", lambda x: x.cast("string"))), "/").alias("declared"), "hap0", "hap1", "measured", status.alias("status"))


def graft_records(edits: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """contig, pos (from 1), ref, alts, gt0, gt1: phased records of both haplotypes' edits.

    edits: contig, hap (0 or 1), start, ref, alt, of one haplotype without overlaps. Edits
    that overlap or touch, on whichever haplotype, are one record over all of them, with
    what each haplotype makes of that span as its allele. Alleles of one length stand as
    they are; where lengths differ the letter before comes along as anchor. Records that
    leave both haplotypes as the reference are dropped. An edit whose ref is not what the
    reference has there ends the job with an error, as does one that needs an anchor at a
    contig's start. blocks: contig, block, seq, `width` letters each but the last; edits
    outside of all blocks, and nulls, have no record."""
    e = edits.where("hap in (0, 1) and start is not null and ref is not null and alt is not null")
    e = e.withColumn("end", F.col("start") + F.greatest(F.length("ref"), F.lit(1)))
    groups = islands(e, ["contig"], edits=F.collect_list(F.struct("start", "hap", "ref", "alt")))  # an island's edits: those of one place
    spans = groups.select("contig", F.col("start").alias("first"), F.col("end").alias("last"), (F.col("start") - 1).alias("start"), "end", "edits")
    text = fetched(spans.select("contig", "first", "start", "end"), ["contig", "first"], blocks, width)
    d = spans.join(text, ["contig", "first"])
    anchored = F.col("first") > 0
    d = d.withColumn("anchor", F.when(anchored, F.substring("text", 1, 1)).otherwise("")).withColumn("ref", F.upper(F.when(anchored, F.substring("text", F.lit(2), F.length("text"))).otherwise(F.col("text"))))

    def made(hap: int) -> Column:
        mine = F.reverse(F.array_sort(F.filter("edits", lambda x: x["hap"] == hap)))

        def apply(s: Column, x: Column) -> Column:
            at = (x["start"] - F.col("first")).cast("int")
            there = F.substring(s, at + 1, F.length(x["ref"])) == F.upper(x["ref"])
            put = F.concat(F.substring(s, F.lit(1), at), F.upper(x["alt"]), F.substring(s, at + F.length(x["ref"]) + 1, F.length(s)))
            wrong = F.raise_error(F.concat(F.lit("an edit's ref differs from the reference at place "), x["start"].cast("string"))).cast("string")
            return F.when(there, put).otherwise(wrong)

        return F.aggregate(mine, F.col("ref"), apply)

    d = d.withColumn("h0", made(0)).withColumn("h1", made(1))
    even = (F.length("h0") == F.length("ref")) & (F.length("h1") == F.length("ref"))
    short = F.raise_error(F.lit("no anchor before an edit at a contig's start")).cast("string")
    lead = F.when(even, "").when(anchored, F.upper("anchor")).otherwise(short)
    d = d.where("h0 <> ref or h1 <> ref").withColumn("lead", lead)
    alleles = let(F.array(*[F.concat("lead", F.col(c)) for c in ("ref", "h0", "h1")]), F.array_distinct)
    d = d.withColumn("alleles", alleles)
    place = lambda c: (F.array_position("alleles", F.concat("lead", F.col(c))) - 1).cast("int")
    return d.select("contig", (F.col("first") + 1 - F.length("lead")).alias("pos"), F.get("alleles", F.lit(0)).alias("ref"), F.slice("alleles", 2, 2).alias("alts"), place("h0").alias("gt0"), place("h1").alias("gt1"))


def signed_components(edges: DataFrame) -> DataFrame:
    """node, root, parity, conflicts: connected components of edges that say alike or
    opposite (a, b, opposite), the least node as root, whether a node is opposite to its
    root, and how many of the component's edges can't be kept so (0: none contradicts).

    Each root goes under the least of its neighbouring roots, with the parity of the edge
    between them (of several the alike one); then roots' roots are looked up until none
    changes. Rounds grow with the logarithm of a component's size; each is written, and only
    counts come to the driver. Loops of a node to itself and nulls are left out."""
    e = edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("opposite").cast("boolean").alias("s")).distinct()
    e = written(e, "links")
    labels = written(e.select("a").union(e.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("root"), F.lit(False).alias("parity")), "labels")

    def between() -> DataFrame:
        left, right = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"), F.col("parity").alias("pa")), labels.select(F.col("node").alias("b"), F.col("root").alias("rb"), F.col("parity").alias("pb"))
        return e.join(left, "a").join(right, "b").select("ra", "rb", (F.col("pa") != F.col("pb")).alias("apart"), "s")

    while True:
        open_links = written(between().where("ra <> rb").select(F.greatest("ra", "rb").alias("node"), F.least("ra", "rb").alias("up"), (F.col("apart") != F.col("s")).alias("s")).distinct(), "open")
        if open_links.isEmpty():
            break
        parents = written(open_links.groupBy("node").agg(F.min(F.struct("up", "s")).alias("m")).select("node", "m.up", "m.s"), "parents")
        while True:  # a parent is less than its child, so this ends
            over = parents.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("s").alias("t"))
            jumped = written(parents.join(over, "up", "left").select("node", F.coalesce("top", "up").alias("up"), (F.col("s") != F.coalesce("t", F.lit(False))).alias("s"), F.col("top").isNotNull().alias("moved")), "parents")
            parents = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        under = parents.select(F.col("node").alias("root"), "up", "s")
        labels = written(labels.join(under, "root", "left").select("node", F.coalesce("up", "root").alias("root"), (F.col("parity") != F.coalesce("s", F.lit(False))).alias("parity")), "labels")
    torn = between().groupBy(F.col("ra").alias("root")).agg(F.count_if(F.col("apart") != F.col("s")).alias("conflicts"))
    return labels.join(torn, "root").select("node", "root", "parity", "conflicts")


def combined_phase(records: DataFrame, panel: DataFrame, links: DataFrame, haploid: DataFrame, seed: int) -> DataFrame:
    """chrom, pos, ref, alt, gt0, gt1 (null where haploid), source: each record's phase.

    records: chrom, pos, ref, alt, gt0, gt1, phased, ps (the block that a phased record
    belongs to); panel: chrom, pos, ref, alt, h0, h1; links: chrom, a, b, opposite between
    blocks; haploid: chrom, start, end. In this order: haploid where the place lies in such
    a span (gt0, if alleles differ: the least of them is taken), hom, panel where the panel
    has the record, block where the block's own records agree with the panel more often one
    way (ties: as they stand), linked where a chain of links leads from the block to such a
    one, component where it leads nowhere (the whole component is turned by a draw), random
    by a draw of the record's own. Links between two blocks that the panel turns itself
    aren't looked at. A record with a null allele keeps it and has no source. Records that
    repeat stay."""
    site = ["chrom", "pos", "ref", "alt"]
    both = F.col("gt0").isNotNull() & F.col("gt1").isNotNull()
    het = both & (F.col("gt0") != F.col("gt1"))
    r = records.withColumn("__id", F.monotonically_increasing_id())
    r = written(r, "records")
    known = panel.dropDuplicates(site)
    votes = r.where(het & F.col("phased") & F.col("ps").isNotNull()).join(known, site).groupBy("chrom", "ps").agg(F.count_if((F.col("gt0") != F.col("h0")) | (F.col("gt1") != F.col("h1"))).alias("no"), F.count(F.lit(1)).alias("n"))
    votes = written(votes.select("chrom", "ps", (F.col("no") * 2 > F.col("n")).alias("flip")), "votes")
    name = lambda ps: F.struct(F.col("chrom"), ps.cast("long").alias("ps"))
    least = F.struct(F.lit("").alias("chrom"), F.lit(-(1 << 62)).cast("long").alias("ps"))  # the panel: before all blocks
    told = votes.select("chrom", F.col("ps").alias("a"), F.lit(True).alias("own_a"))
    chain = links.join(told, ["chrom", "a"], "left").join(told.select("chrom", F.col("a").alias("b"), F.col("own_a").alias("own_b")), ["chrom", "b"], "left").where("own_a is null or own_b is null")
    edges = votes.select(least.alias("a"), name(F.col("ps")).alias("b"), F.col("flip").alias("opposite")).unionByName(chain.select(name(F.col("a")).alias("a"), name(F.col("b")).alias("b"), "opposite"))
    c = signed_components(edges)
    turn = F.when(F.col("root.chrom") == "", F.col("parity")).otherwise(F.col("parity") != (uniform(seed, F.concat_ws(":", "root.chrom", F.col("root.ps").cast("string"))) >= 0.5))
    blocks = c.where(F.col("node.chrom") != "").select(F.col("node.chrom").alias("chrom"), F.col("node.ps").alias("ps"), turn.alias("turn"), (F.col("root.chrom") == "").alias("anchored"))
    blocks = blocks.join(votes.select("chrom", "ps", F.lit(True).alias("own")), ["chrom", "ps"], "left")
    lone = point_join(r.select("__id", "chrom", "pos"), haploid.select("chrom", "start", "end"), ["chrom"], how="left_semi").select("__id", F.lit(True).alias("__one"))
    d = r.join(lone, "__id", "left").join(known, site, "left").join(blocks, ["chrom", "ps"], "left")
    inside = het & F.col("phased") & F.col("turn").isNotNull()
    source = F.when(~both, None).when(F.col("__one"), "haploid").when(~het, "hom").when(F.col("h0").isNotNull(), "panel")
    source = source.when(inside & F.col("own"), "block").when(inside & F.col("anchored"), "linked").when(inside, "component").otherwise("random")
    d = d.withColumn("source", source)
    swap = F.when(F.col("source").isin("block", "linked", "component"), F.col("turn")).when(F.col("source") == "random", uniform(seed, F.concat_ws(":", *[F.col(c).cast("string") for c in site])) >= 0.5).otherwise(False)
    first = F.when(F.col("source") == "haploid", F.least("gt0", "gt1")).when(F.col("source") == "panel", F.col("h0")).when(swap, F.col("gt1")).otherwise(F.col("gt0"))
    second = F.when(F.col("source") == "haploid", None).when(F.col("source") == "panel", F.col("h1")).when(swap, F.col("gt0")).otherwise(F.col("gt1"))
    return d.select(*site, first.alias("gt0"), second.alias("gt1"), "source")
