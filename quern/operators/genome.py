"""Composites over places of a genome: context, epitopes, fusion junctions, uniform slices.

Places count from 0 and spans are half-open unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..functions.sequence import reverse_complement
from ..sources.folders import written
from .intervals import asof_join, coalesce_equal, flanks, greedy, islands, overlap_join, point_join
from .sampling import uniform

STOPS = ("TAA", "TAG", "TGA")  # fixed values: stop codons of the standard code
_BEFORE_STOP = f"(?s)^(?:(?!{'|'.join(STOPS)})...)*+"  # the codons before the first stop


def fetched(spans: DataFrame, key: Sequence[str], blocks: DataFrame, width: int) -> DataFrame:
    """key, text: the letters of each span (key, contig, start, end; cut at the contig's ends).
    blocks: contig, block, seq, `width` letters each but the last. A span meets the few blocks
    that it touches; one outside of all has no row. Blocks are merged, not broadcast: letters
    may be made by functions, so the size of the tables read doesn't tell theirs."""
    d = spans.select(*key, F.col("contig").alias("__on"), F.greatest("start", F.lit(0)).alias("__s"), F.col("end").alias("__e")).where("__e > __s")
    d = d.withColumn("__b", F.explode(F.sequence(F.floor(F.col("__s") / width), F.floor((F.col("__e") - 1) / width))))
    b = blocks.select(F.col("contig").alias("__c"), F.col("block").alias("__k"), F.col("seq").alias("__seq"))
    low, high = F.greatest("__s", F.col("__k") * width), F.least(F.col("__e"), F.col("__k") * width + F.length("__seq"))
    d = d.join(b.hint("merge"), (F.col("__on") == F.col("__c")) & (F.col("__b") == F.col("__k"))).where(high > low)
    piece = F.substring(F.col("__seq"), (low - F.col("__k") * width + 1).cast("int"), (high - low).cast("int"))
    d = d.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("__k", piece.alias("s")))).alias("__p"))  # a few blocks
    return d.select(*key, F.array_join(F.transform("__p", lambda x: x["s"]), "").alias("text"))


def surroundings(sites: DataFrame, blocks: DataFrame, width: int, reach: int) -> DataFrame:
    """contig, pos, text, at: the letters in [pos - reach, pos + reach), cut at the contig's
    ends, and where in them the site stands. Blocks as in fetched, without holes."""
    spans = sites.select("contig", "pos", (F.col("pos") - reach).alias("start"), (F.col("pos") + reach).alias("end"))
    return fetched(spans, ["contig", "pos"], blocks, width).withColumn("at", (F.col("pos") - F.greatest(F.col("pos") - reach, F.lit(0))).cast("int"))


def junction_contigs(events: DataFrame, blocks: DataFrame, width: int, flank: int) -> DataFrame:
    """event, side, kind, sequence: what a read over each new join shows, `flank` letters a side.

    events: event, kind, contig, start, end_contig, end (places from 1), element (the text
    put in). DEL and TRA go on from start to end, DUP from end back to start, INV meets the
    other strand before end. INS and VIRUS have two joins, 5p into the element and 3p out
    of it. Other kinds, nulls, and joins shorter than `flank` have no row."""
    e = events.select("event", "kind", "contig", F.coalesce("end_contig", "contig").alias("far"), "start", F.coalesce("end", "start").alias("end"), "element")
    s, t, own, far, none = F.col("start"), F.col("end"), F.col("contig"), F.col("far"), F.lit(None).cast("string")

    def piece(side: str, part: int, contig, low, turned: bool = False, text=none):
        return F.struct(F.lit(side).alias("side"), F.lit(part).alias("part"), contig.alias("on"), (low - 1).cast("long").alias("low"), F.lit(turned).alias("turned"), text.alias("text"))

    upto = lambda side, part, contig, at, turned=False: piece(side, part, contig, at - flank + 1, turned)
    into = piece("5p", 1, F.lit(None).cast(events.schema["contig"].dataType), F.lit(None).cast("long"), text=F.substring("element", F.lit(1), F.lit(flank)))
    out = piece("3p", 0, F.lit(None).cast(events.schema["contig"].dataType), F.lit(None).cast("long"), text=F.right("element", F.lit(flank)))
    parts = F.when(F.col("kind").isin("DEL", "TRA"), F.array(upto("", 0, own, s), piece("", 1, F.when(F.col("kind") == "TRA", far).otherwise(own), t)))
    parts = parts.when(F.col("kind") == "DUP", F.array(upto("", 0, own, t), piece("", 1, own, s)))
    parts = parts.when(F.col("kind") == "INV", F.array(upto("", 0, own, s), upto("", 1, own, t, True)))
    parts = parts.when(F.col("kind").isin("INS", "VIRUS") & (F.length("element") > 0), F.array(upto("5p", 0, own, s), into, out, piece("3p", 1, own, s + 1)))
    d = e.where("start is not null").select("event", "kind", F.explode(parts).alias("p")).select("event", "kind", "p.*")
    key = ["event", "side", "part"]
    spans = d.where("text is null").select(*key, F.col("on").alias("contig"), F.col("low").alias("start"), (F.col("low") + flank).alias("end"))
    got = fetched(spans, key, blocks, width).withColumnRenamed("text", "__text")
    d = d.join(got, key, "left").withColumn("text", F.coalesce("text", F.when(F.col("turned"), reverse_complement(F.col("__text"))).otherwise(F.col("__text")), F.lit("")))
    d = d.groupBy("event", "side", "kind").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))  # two parts
    return d.select("event", "side", "kind", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("sequence")).where(F.length("sequence") >= flank)


def run_length(text: Column, at: Column, reach: int = 12) -> Column:
    """The longest run of one letter, within `reach` of place `at` (from 0), that touches
    it or a neighbour; null without a text."""
    low = F.greatest(at - reach, F.lit(0))
    near = F.struct(F.substring(text, low + 1, at - low + reach + 1).alias("s"), (at - low).alias("c"))

    def through(s: Column, i: Column) -> Column:
        letter, upto, since = F.substring(s, i + 1, F.lit(1)), F.substring(s, F.lit(1), i + 1), F.substring(s, i + 1, F.length(s))
        n = F.length(upto) - F.length(F.rtrim(upto, letter)) + F.length(since) - F.length(F.ltrim(since, letter)) - 1
        return F.when((i >= 0) & (i < F.length(s)), n).otherwise(1)

    # Names for the letters and the place: written out where each is used, the plan takes minutes to make.
    longest = F.transform(F.array(near), lambda z: F.array_max(F.transform(F.array(z["c"] - 1, z["c"], z["c"] + 1), lambda i: through(z["s"], i))))
    return F.when(text.isNotNull(), longest[0])


def context_features(sites: DataFrame, blocks: DataFrame, width: int, hets: DataFrame, capture: DataFrame, repeats: DataFrame, segdups: DataFrame, coding: DataFrame, reach: int = 30) -> DataFrame:
    """Nine columns a distinct site (contig, pos): homopolymer_run, hets_near, nearest_het
    (other heterozygous places within `reach`), capture_edge (distance to the nearer edge
    of a capture span, null outside), on_target, repeat (name of the first that covers
    it), segdup, cds_edge, gc (of 100 letters).

    blocks as in surroundings; hets: contig, pos; capture, segdups, coding: contig, start,
    end; repeats with name. Sites are bits of spots of 64 places: a spot fetches its letters
    once and meets the spans that touch it once, those that cover the same of its places as
    one. Sites without a place have no row; sites outside of the blocks have null
    homopolymer_run and gc."""
    size, key = 64, ["contig", "spot"]
    pos, base = F.col("pos"), F.col("spot") * size
    spots = sites.where("pos is not null").groupBy("contig", F.floor(pos / size).alias("spot"))
    spots = written(spots.agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(pos, {size}) as int)))").alias("here")), "spots")
    letters = fetched(spots.select(*key, (base - 50).alias("start"), (base + size + 50).alias("end")), key, blocks, width)
    around = hets.where("pos is not null").select("contig", (pos - reach).alias("start"), (pos + reach + 1).alias("end")).distinct()
    spans = repeats.select(F.lit("rep").alias("kind"), "contig", "start", "end", "name")
    for kind, d in (("het", around), ("capture", capture), ("dup", segdups), ("cds", coding)):
        spans = spans.unionByName(d.select(F.lit(kind).alias("kind"), "contig", "start", "end"), allowMissingColumns=True)
    met = overlap_join(spots.select(*key, base.alias("start"), (base + size).alias("end")), spans, ["contig"], width=1000)
    covers = (F.greatest(F.col("b_start"), "start") - F.col("start"), F.least(F.col("b_end"), "end") - F.col("start"), F.when(F.col("b_kind") == "het", F.col("b_start")))
    met = met.groupBy(*key, "b_kind", *[c.alias(f"__{i}") for i, c in enumerate(covers)]).agg(F.max("b_start").alias("s"), F.min("b_end").alias("e"), F.min(F.struct(F.col("b_start").alias("s"), F.col("b_end").alias("e"), F.col("b_name").alias("name"))).alias("rep"))
    of = lambda kind, x: F.collect_list(F.when(F.col("b_kind") == kind, x)).alias(kind)
    met = met.groupBy(*key).agg(of("het", F.col("s") + reach), of("rep", F.col("rep")), *[of(kind, F.struct("s", "e")) for kind in ("capture", "dup", "cds")])
    d = spots.join(letters, key, "left").join(met, key, "left")
    d = d.withColumn("__at", F.explode(F.expr(f"filter(sequence(0, {size - 1}), i -> shiftright(here, i) & 1 = 1)"))).withColumn("pos", (base + F.col("__at")).cast(sites.schema["pos"].dataType))
    low = F.greatest(pos - 50, F.lit(0))
    text = F.substring("text", (low - F.greatest(base - 50, F.lit(0)) + 1).cast("int"), (pos + 50 - low).cast("int"))
    d = d.withColumn("text", F.when(F.length(text) > 0, text)).withColumn("at", (pos - low).cast("int"))
    inside = lambda kind: F.filter(kind, lambda x: (pos >= x["s"]) & (pos < x["e"]))
    edge = lambda kind: F.array_min(F.transform(inside(kind), lambda x: F.least(pos - x["s"], x["e"] - 1 - pos)))
    far = F.filter(F.transform("het", lambda x: F.abs(x - pos)), lambda x: (x > 0) & (x <= reach))
    gc = (F.length("text") - F.length(F.replace(F.replace("text", F.lit("G"), F.lit("")), F.lit("C"), F.lit("")))) / F.length("text")
    d = d.select("contig", "pos", run_length(F.col("text"), F.col("at")).alias("homopolymer_run"), far.alias("far"), edge("capture").alias("capture_edge"), F.array_min(inside("rep")).alias("rep"), (F.size(inside("dup")) > 0).alias("dup"), edge("cds").alias("cds_edge"), F.round(gc, 3).alias("gc"))
    near = [F.coalesce(F.size("far"), F.lit(0)).cast("long").alias("hets_near"), F.array_min("far").alias("nearest_het")]
    return d.select("contig", "pos", "homopolymer_run", *near, "capture_edge", F.col("capture_edge").isNotNull().alias("on_target"), F.col("rep.name").alias("repeat"), F.coalesce("dup", F.lit(False)).alias("segdup"), "cds_edge", "gc")


def epitopes(candidates: DataFrame, peptides: DataFrame, alleles: Sequence[str], score: Callable[[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """The best peptide of each candidate over all alleles and over those not lost.

    candidates: key, mutant, wild (proteins of one register), lost (array of alleles);
    peptides: key, pep. score(peptide, allele) gives rank and affinity. Best is least by
    (rank, peptide, allele). n_low counts peptides whose best rank is 2 or less.
    wt_peptide stands in the wild protein where the best one does in the mutant, null if
    it is the same or doesn't fit, scored for the best allele; agretopicity is its
    affinity over the mutant's. Candidates without peptides keep nulls and the tier na."""
    c = candidates.select("key", "mutant", "wild", "lost")
    pairs = peptides.select("key", "pep").distinct().join(c.select("key", "lost"), "key").withColumn("allele", F.explode(F.array(*[F.lit(a) for a in alleles])))
    rank, affinity = score(F.col("pep"), F.col("allele"))
    one = F.struct(rank.alias("rank"), "pep", "allele", affinity.alias("affinity"))
    pairs = pairs.select("key", "pep", one.alias("x"), (~F.array_contains("lost", F.col("allele"))).alias("kept"))
    each = pairs.groupBy("key", "pep").agg(F.min("x").alias("x"), F.min(F.when(F.col("kept"), F.col("x"))).alias("r"))
    best = each.groupBy("key").agg(F.min("x").alias("x"), F.min("r").alias("r"), F.count_if(F.col("x.rank") <= 2).alias("n_low"))
    at = F.instr(F.col("mutant"), F.col("x.pep"))
    wt = F.substring(F.col("wild"), at, F.length("x.pep"))
    d = c.join(best, "key", "left").withColumn("wt_peptide", F.when((at > 0) & (F.length(wt) == F.length("x.pep")) & (wt != F.col("x.pep")), wt))
    wt_rank, wt_affinity = score(F.col("wt_peptide"), F.col("x.allele"))
    tier = lambda r: sc.tier(r, [0.5, 2], ["strong", "weak", "non"], inclusive=True)
    return d.select(
        "key", F.col("x.rank").alias("best_rank"), F.col("x.allele").alias("best_allele"), F.col("x.affinity").alias("best_affinity"), F.col("x.pep").alias("best_peptide"), tier(F.col("x.rank")).alias("tier"),
        F.coalesce("n_low", F.lit(0)).alias("n_low"), F.col("r.rank").alias("retained_rank"), F.col("r.allele").alias("retained_allele"), F.col("r.pep").alias("retained_peptide"), tier(F.col("r.rank")).alias("retained_tier"),
        F.coalesce(F.array_contains("lost", F.col("x.allele")), F.lit(False)).alias("best_is_lost"), "wt_peptide", F.when(F.col("wt_peptide").isNotNull(), wt_rank).alias("wt_rank"),
        F.when(F.col("wt_peptide").isNotNull(), F.try_divide(wt_affinity, F.col("x.affinity"))).alias("agretopicity"))


def junctions(pairs: DataFrame, key: Sequence[str], in_frame: bool, least: int, seed: int) -> DataFrame:
    """A junction for each pair of partners: key, options, i, j, protein_len.

    pairs: key, left, right: coding segments in order, as arrays of texts. All cuts after
    segment i of left and before segment j of right (both from 1, never the whole) are
    tried; a cut is kept if the left part's length is a multiple of three (in_frame) or not,
    no stop comes before the junction, and the protein has `least` residues (out of frame:
    five past the junction). Of the four nearest to the middle of both partners one is
    drawn by key; with fewer the nearest stays. Pairs without any have no row."""
    every = lambda name: F.when(F.size(name) > 1, F.sequence(F.lit(1), F.size(name) - 1)).otherwise(F.array().cast("array<int>"))
    before_stop = lambda text: F.floor(F.length(F.regexp_extract(text, _BEFORE_STOP, 0)) / 3)
    head = F.array_join(F.slice("left", F.lit(1), F.col("i")), "")
    d = pairs.withColumn("i", F.explode(every("left"))).withColumn("__h", head).withColumn("__head", F.length("__h")).withColumn("__codon", F.floor(F.col("__head") / 3))
    # A stop in the left part rules out all cuts behind it, before any right part is looked at.
    d = d.where((F.col("__head") % 3 == 0) if in_frame else (F.col("__head") % 3 != 0)).where(before_stop(F.col("__h")) == F.col("__codon"))
    d = d.withColumn("j", F.explode(every("right")))
    # From the codon of the junction on: what is left of it, and the right part.
    rest = F.concat(F.substring(F.col("__h"), (F.col("__codon") * 3 + 1).cast("int"), F.lit(3)), F.array_join(F.slice("right", F.col("j") + 1, F.size("right")), ""))
    d = d.withColumn("protein_len", (F.col("__codon") + before_stop(rest)).cast("long")).where(F.col("protein_len") >= (F.lit(least) if in_frame else F.col("__codon") + 5))
    off = F.abs(F.col("i") / F.size("left") - 0.5) + F.abs(F.col("j") / F.size("right") - 0.5)
    d = d.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(off.alias("off"), "i", "j", "protein_len"))).alias("o"))  # segments squared, a pair
    pick = F.when(F.size("o") < 4, F.lit(1)).otherwise(F.floor(uniform(seed, *key) * 4).cast("int") + 1)
    chosen = F.element_at("o", pick)
    return d.select(*key, F.size("o").alias("options"), chosen["i"].alias("i"), chosen["j"].alias("j"), chosen["protein_len"].alias("protein_len"))


def uniform_slices(pieces: DataFrame, cuts: DataFrame, by: Sequence[str], least: int, width: int = 64) -> DataFrame:
    """A derived sequence cut into slices of one copy number: by, contig, band, start, end, n.

    pieces: by, ordinal, d_start, d_end (derived), contig, r_start, r_end (reference, all
    inclusive), strand, inserted. cuts: contig, pos: where the copy number can change.
    Pieces are cut there, in derived order; one shorter than `least` is folded into
    the slice before it on the same contig, an inserted piece always (the first stays, on
    its own contig). Neighbours that touch, of one contig and band, become one slice. band is
    the last cut at or before the slice's place, null before the first. n counts folded
    slices. The pieces of one derived sequence, a plan's rows, meet in a task; slices of
    all sequences ask for bands by distinct places, so no contig's slices meet."""
    id_ = [*by, "ordinal"]
    body = pieces.where("not inserted and r_end >= r_start")
    cuts = cuts.select("contig", "pos").where("pos is not null").distinct()
    spans = body.withColumn("start", F.col("r_start") + 1).withColumn("end", F.col("r_end") + 1)
    inner = point_join(cuts, spans, ["contig"], width=width).select(*body.columns, F.col("pos").alias("a"))
    marks = body.withColumn("a", F.col("r_start")).unionByName(inner)
    until = F.coalesce(F.lead("a").over(Window.partitionBy(*id_).orderBy("a")) - 1, F.col("r_end"))
    d = marks.withColumn("b", until)
    turned = F.col("strand") == "-"
    low = F.col("d_start") + F.when(turned, F.col("r_end") - F.col("b")).otherwise(F.col("a") - F.col("r_start"))
    high = F.col("d_start") + F.when(turned, F.col("r_end") - F.col("a")).otherwise(F.col("b") - F.col("r_start"))
    parts = d.select(*by, "contig", low.alias("start"), F.least(high, F.col("d_end")).alias("end"), F.floor((F.col("a") + F.col("b")) / 2).alias("at"), F.lit(False).alias("inserted")).where("`end` >= start")
    rest = pieces.where("inserted or r_end < r_start or r_start is null or r_end is null")
    parts = parts.unionByName(rest.select(*by, "contig", F.col("d_start").alias("start"), F.col("d_end").alias("end"), F.coalesce(F.col("r_start"), F.lit(1)).cast("long").alias("at"), F.lit(True).alias("inserted")))
    w = Window.partitionBy(*by).orderBy("start", "end")
    parts = parts.withColumn("__first", F.row_number().over(w) == 1).withColumn("__own", F.when(F.col("__first") | ~F.col("inserted"), F.col("contig")))
    last = F.last("__own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    long_ = F.col("end") - F.col("start") + 1 >= least
    head = F.col("__first") | (~F.col("inserted") & (long_ | (last != F.col("contig"))))
    parts = parts.withColumn("__slice", F.sum(head.cast("int")).over(w))
    first = F.min(F.struct("start", "contig", "at")).alias("f")
    d = parts.groupBy(*by, "__slice").agg(first, F.max("end").alias("end")).select(*by, "f.contig", "f.at", "f.start", (F.col("end") + 1).alias("end"))
    d = written(d, "slices")
    bands = asof_join(d.select("contig", "at").distinct(), cuts.select("contig", F.col("pos").alias("at"), F.col("pos").alias("band")), ["contig"], "at", ["band"])
    d = written(d.join(bands, ["contig", "at"], "left"), "bands")
    return coalesce_equal(d, by, ["contig", "band"]).withColumn("end", F.col("end") - 1)


def _array_of(df: DataFrame, one: Column) -> str:
    """The type of an array of such elements."""
    return f"array<{df.select(one.alias('x')).schema['x'].dataType.simpleString()}>"


def derived_plan(lengths: DataFrame, events: DataFrame, moves: DataFrame, margin: int) -> tuple[DataFrame, DataFrame]:
    """The pieces that make up each rearranged contig, and what became of each event.

    Places count from 1 and ends are inclusive. lengths: contig, length; events: contig,
    event, kind (DEL, DUP, INV, INS), start, end (either order), ins_len; moves
    (translocations): event, a, pos_a, b, pos_b. Of events that overlap the first by
    (start, end, event) is laid out; those within `margin` of an end are outside.
    A deletion leaves its span out, a duplication has it twice, an inversion turns it, an
    insertion puts ins_len letters behind it. A move is placed where it is the only one of
    both its contigs: the pieces up to its place go on with the partner's rest. It is
    not placed on a contig where its place falls inside a piece other than plain reference.

    pieces: contig, ordinal, d_start, d_end, source, r_start, r_end, strand, kind, event.
    report: event, contig, status. Contigs without a length have neither; the events of a
    contig, rows of a plan, meet in a task."""
    span = [F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end")]
    ev = events.where("start is not null and `end` is not null").select("contig", "event", "kind", "ins_len", *span).join(lengths, "contig")
    outside = (F.col("start") < margin) | (F.col("end") > F.col("length") - margin)
    fit = ev.where(~outside)
    choice = greedy(fit.select("contig", "event", "start", (F.col("end") + 1).alias("end")), ["contig"], "event").select("contig", "event", "kept")
    kept = fit.join(choice.where("kept"), ["contig", "event"])

    w = Window.partitionBy("contig").orderBy("start")

    def piece(step: int, low, high, strand: str, kind: str, event: Column, ins: Column | None = None) -> Column:
        n = F.lit(0) if ins is None else ins
        return F.struct(F.lit(step).alias("step"), low.cast("long").alias("r_start"), high.cast("long").alias("r_end"), F.lit(strand).alias("strand"), F.lit(kind).alias("kind"), event.cast("string").alias("event"), n.cast("long").alias("ins"))

    s, e, name, none = F.col("start"), F.col("end"), F.col("event"), F.lit(None)
    before = piece(0, F.coalesce(F.lag("end").over(w), F.lit(0)) + 1, s - 1, "+", "ref", none)
    own = F.when(F.col("kind") == "DUP", F.array(piece(1, s, e, "+", "ref", name), piece(2, s, e, "+", "dup", name)))
    own = own.when(F.col("kind") == "INV", F.array(piece(1, s, e, "-", "inv", name)))
    own = own.when(F.col("kind") == "INS", F.array(piece(1, s, e, "+", "ref", name), piece(2, s, s, "+", "insert", name, F.col("ins_len"))))
    own = F.coalesce(own, F.array().cast(_array_of(kept, piece(0, s, e, "+", "ref", name))))
    laid = kept.withColumn("__before", before).select("contig", s.alias("o"), F.explode(F.concat(F.array("__before"), own)).alias("p"))
    last = lengths.join(kept.groupBy("contig").agg(F.max("end").alias("end")), "contig", "left")
    tail = last.select("contig", (F.col("length") + 1).alias("o"), piece(0, F.coalesce("end", F.lit(0)) + 1, F.col("length"), "+", "ref", none).alias("p"))
    plan = laid.unionByName(tail).select("contig", "o", "p.*").where("r_start <= r_end")

    ends = moves.select(F.col("event").cast("string").alias("move"), F.explode(F.array(
        F.struct(F.col("a").alias("contig"), F.col("pos_a").alias("cut"), F.col("b").alias("partner"), (F.col("pos_b") + 1).alias("since")),
        F.struct(F.col("b").alias("contig"), F.col("pos_b").alias("cut"), F.col("a").alias("partner"), (F.col("pos_a") + 1).alias("since")))).alias("x")).select("move", "x.*")
    many = ends.groupBy("contig").agg(F.count(F.lit(1)).alias("n"))
    ends = ends.join(many, "contig").join(many.select(F.col("contig").alias("partner"), F.col("n").alias("m")), "partner")
    single = ends.where("n = 1 and m = 1").join(lengths.select(F.col("contig").alias("partner"), F.col("length").alias("rest")), "partner", "left")
    d = plan.join(single.select("contig", "move", "cut", "partner", "since", "rest"), "contig", "left")
    plain = (F.col("kind") == "ref") & (F.col("strand") == "+")
    crossed = (F.col("r_start") <= F.col("cut")) & (F.col("r_end") > F.col("cut"))
    able = d.where("move is not null").groupBy("contig", "move").agg((~F.bool_or(crossed & ~plain) & F.bool_or(F.col("r_start") <= F.col("cut")) & F.coalesce(F.max("since") <= F.max("rest"), F.lit(False))).alias("able"))
    d = d.join(able.select("contig", "able"), "contig", "left").withColumn("able", F.coalesce("able", F.lit(False)))
    head = d.where(~F.col("able") | (F.col("r_start") <= F.col("cut")))
    head = head.select("contig", "o", "step", F.col("contig").alias("source"), "r_start", F.when(F.col("able"), F.least("r_end", "cut")).otherwise(F.col("r_end")).alias("r_end"), "strand", "kind", "event", "ins")
    joined = d.where("able").select("contig", "move", "partner", "since", "rest").distinct()
    joined = joined.select("contig", F.lit(None).cast("long").alias("o"), F.lit(3).alias("step"), F.col("partner").alias("source"), F.col("since").cast("long").alias("r_start"), F.col("rest").cast("long").alias("r_end"), F.lit("+").alias("strand"), F.lit("ref").alias("kind"), F.col("move").alias("event"), F.lit(0).cast("long").alias("ins"))
    out = head.unionByName(joined)
    order = Window.partitionBy("contig").orderBy(F.col("o").asc_nulls_last(), "step")
    n = F.when(F.col("kind") == "insert", F.col("ins")).otherwise(F.col("r_end") - F.col("r_start") + 1)
    out = out.withColumn("__n", n).withColumn("ordinal", F.row_number().over(order)).withColumn("d_end", F.sum("__n").over(order))
    pieces = out.select("contig", "ordinal", (F.col("d_end") - F.col("__n") + 1).alias("d_start"), "d_end", "source", "r_start", "r_end", "strand", "kind", "event")

    report = ev.where(outside).select(name.cast("string").alias("event"), "contig", F.lit("outside").alias("status"))
    report = report.unionByName(choice.select(name.cast("string").alias("event"), "contig", F.when(F.col("kept"), "applied").otherwise("dropped").alias("status")))
    moved = ends.join(able.withColumnRenamed("move", "__m"), ["contig"], "left").select(F.col("move").alias("event"), "contig", F.when((F.col("n") > 1) | (F.col("m") > 1), "skipped").when(F.col("able"), "placed").otherwise("not placed").alias("status"))
    return pieces, report.unionByName(moved.join(lengths.select("contig"), "contig", "left_semi").select("event", "contig", "status"))


def off_target(spans: DataFrame, by: Sequence[str], bands: Sequence[tuple[str, int, int, float]], length: str, least: int) -> DataFrame:
    """by, band, depth, start, end: bands beside merged spans (inclusive places; `length`
    names a column of their contig's length), from lo to hi places away, cut where a
    neighbour begins; those shorter than `least` are left out."""
    # One place more than the farthest band reaches, so that a side always ends on a place outside.
    d = flanks(spans, by, max(hi for _, _, hi, _ in bands) + 1)
    neighbour, beyond = F.col("left_start") + 1, F.col("right_end") - 1
    sides = []
    for name, lo, hi, share in bands:
        label = [F.lit(name).alias("band"), F.lit(share).alias("depth")]
        sides.append(F.struct(*label, F.greatest(neighbour, F.col("start") - hi, F.lit(1)).alias("start"), (F.col("start") - lo).alias("end")))
        sides.append(F.struct(*label, (F.col("end") + lo).alias("start"), F.least(beyond, F.col("end") + hi, F.col(length) - 1).alias("end")))
    return d.select(*by, F.explode(F.array(*sides)).alias("x")).select(*by, "x.*").where(F.col("end") - F.col("start") + 1 >= least)


def distal(contigs: DataFrame, spans: DataFrame, n: int, size: int, reach: int, seed: int, tries: int) -> DataFrame:
    """contig, start, end: up to n windows of `size` a contig, drawn by key out of `tries`,
    none within `reach` of a span (contig, start, end inclusive). contigs: contig, length."""
    # Starts at which a window would touch a span's surroundings; they are merged, so a bin has few.
    bad = spans.where(F.col("end") + reach + 1 > F.greatest(F.lit(1), F.col("start") - reach))
    bad = islands(bad.select("contig", (F.greatest(F.lit(1), F.col("start") - reach) - size).alias("start"), (F.col("end") + reach + 1).alias("end")), ["contig"])
    width = 32 * (size + 2 * reach + 1)
    bad = bad.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    bad = bad.groupBy(F.col("contig").alias("__on"), F.col("__bin").alias("__of")).agg(F.collect_list(F.struct("start", "end")).alias("__bad"))
    at = lambda i: (F.lit(1) + F.floor(uniform(seed, "contig", i) * F.greatest(F.lit(1), F.col("length") - size - 1))).cast("long")
    d = contigs.withColumn("__all", F.transform(F.sequence(F.lit(1), F.lit(tries)), lambda i: F.struct(i.alias("i"), at(i).alias("start"))))
    d = d.withColumn("__bin", F.explode(F.array_distinct(F.transform("__all", lambda x: F.floor(x["start"] / width)))))
    d = d.join(bad, (F.col("contig") == F.col("__on")) & (F.col("__bin") == F.col("__of")), "left")
    free = F.filter("__all", lambda x: F.floor(x["start"] / width).eqNullSafe(F.col("__bin")) & ~F.coalesce(F.exists("__bad", lambda y: (x["start"] >= y["start"]) & (x["start"] < y["end"])), F.lit(False)))
    first = F.slice(F.array_sort(F.flatten(F.collect_list(free))), 1, n)
    return d.groupBy("contig").agg(first.alias("__x")).select("contig", F.explode("__x.start").alias("start")).select("contig", "start", (F.col("start") + size - 1).alias("end"))
