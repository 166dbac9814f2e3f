"""Germline alleles given by coding places, resolved to records and held against what is expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import editing
from ..functions.sequence import reverse_complement, translate
from .genome import fetched
from .intervals import overlap_join

REACH = 200  # letters before a change in which it may be written further left


def coding_texts(transcripts: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """transcripts (gene, contig, strand, exons: start, end of the coding parts, ascending) with
    cds, the coding letters in reading direction, and places, the genome's place of each."""
    parts = transcripts.select("gene", "contig", F.posexplode("exons").alias("i", "e")).select("gene", "i", "contig", "e.start", "e.end")
    text = fetched(parts, ["gene", "i"], blocks, width).groupBy("gene").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("t"))  # a gene's exons
    d = transcripts.join(text, "gene", "left")
    letters = F.coalesce(F.array_join(F.transform("t", lambda x: F.upper(x["text"])), ""), F.lit(""))
    places = F.flatten(F.transform("exons", lambda e: F.sequence(e["start"].cast("long"), e["end"].cast("long") - 1)))
    minus = F.col("strand") == "-"
    return d.select("gene", "contig", "strand", F.when(minus, reverse_complement(letters)).otherwise(letters).alias("cds"), F.when(minus, F.reverse(places)).otherwise(places).alias("places"))


def resolve(specs: DataFrame, transcripts: DataFrame, blocks: DataFrame, width: int, germline: DataFrame, losses: DataFrame) -> DataFrame:
    """event, contig, pos (from 1), ref, alt, haplotype, codon, wt_aa, consequence, problems.

    specs: event, gene, first, last (coding places from 1 that are deleted), haplotype (0, 1 or
    retained: the one side that the loss named label leaves), label, and what is expected:
    expect_codon, expect_aa, expect_effect (null: anything). germline: contig, start, end of changes that are there;
    losses: label, cn0, cn1. The record has the letter before the deletion and is written as
    far left as it can be. problems names, comma-joined, all that is wrong: no transcript,
    past the coding sequence, spans an intron, other codon, residue or consequence than
    expected, a change is there already, no single haplotype; it is empty where all is well.
    A record that has no places gives nulls. Genes have one transcript; labels one loss."""
    asked = transcripts.join(specs.select("gene").distinct(), "gene", "left_semi")  # texts and places of these alone
    d = specs.join(coding_texts(asked, blocks, width), "gene", "left").withColumn("n", F.col("last") - F.col("first") + 1)
    none, past = F.col("cds").isNull(), F.col("last") > F.length("cds")
    at = F.when(~none & ~past & (F.col("n") > 0), F.slice("places", F.col("first").cast("int"), F.col("n").cast("int")))
    d = d.withColumn("low", F.array_min(at)).withColumn("high", F.array_max(at))
    split = F.col("high") - F.col("low") != F.col("n") - 1
    gone = F.substring(F.col("cds"), F.col("first").cast("int"), F.col("n").cast("int"))
    d = d.withColumn("codon", F.floor((F.col("first") - 1) / 3) + 1).withColumn("wt_aa", F.nullif(translate(F.substring(F.col("cds"), (F.col("codon") * 3 - 2).cast("int"), F.lit(3))), F.lit("")))
    fits = ~none & F.col("low").isNotNull()
    told = editing.consequence(F.coalesce("cds", F.lit("")), F.lit(""), (F.col("first") - 1).cast("long"), F.when(fits, gone).otherwise(""), F.lit(""))
    d = d.withColumn("consequence", F.when(fits, told["consequence"]))
    # The letters from REACH before the deletion to its end, in which it is moved left.
    spans = d.where("low is not null").select("event", "contig", (F.col("low") - 1 - REACH).alias("start"), (F.col("high") + 1).alias("end"))
    d = d.join(fetched(spans, ["event"], blocks, width), "event", "left")
    begin = F.greatest(F.col("low") - 1 - REACH, F.lit(0))
    anchor = F.col("low") - 1 - begin
    ref = F.substring("text", (anchor + 1).cast("int"), (F.col("n") + 1).cast("int"))
    usable = F.col("text").isNotNull() & (F.col("low") > 0) & ~split
    v = editing.left_align(F.coalesce("text", F.lit("")), F.when(usable, anchor).otherwise(0).cast("long"), F.when(usable, ref).otherwise("A"), F.when(usable, F.substring(ref, 1, 1)).otherwise("C"))
    d = d.withColumn("v", v).withColumn("at", F.when(usable, begin + F.col("v.pos")))
    mine = d.where("at is not null").select("event", "contig", F.col("at").alias("start"), (F.col("at") + F.length("v.ref")).alias("end"))
    there = overlap_join(mine, germline.select("contig", "start", "end"), ["contig"]).select("event").distinct().withColumn("there", F.lit(True))
    kept = losses.select("label", F.when((F.col("cn0") > 0) & (F.col("cn1") <= 0), "0").when((F.col("cn1") > 0) & (F.col("cn0") <= 0), "1").alias("kept"))
    d = d.join(there, "event", "left").join(kept, "label", "left")
    d = d.withColumn("hap", F.when(F.col("haplotype") == "retained", F.col("kept")).when(F.col("haplotype").isin("0", "1"), F.col("haplotype")).try_cast("int"))
    differs = lambda own, want: F.coalesce(~F.col(own).eqNullSafe(F.col(want)) & F.col(want).isNotNull(), F.lit(False))
    d = d.withColumnsRenamed({"expect_codon": "__codon", "expect_aa": "__aa", "expect_effect": "__effect"})
    said: list[tuple[Column, str]] = [
        (none, "no transcript"), (~none & past, "past the coding sequence"), (F.coalesce(split, F.lit(False)), "spans an intron"), (differs("codon", "__codon"), "other codon"),
        (differs("wt_aa", "__aa"), "other residue"), (differs("consequence", "__effect"), "other consequence"), (F.col("there").isNotNull(), "a change is there"), (F.col("hap").isNull(), "no single haplotype")]
    problems = F.concat_ws(",", *[F.when(test, text) for test, text in said])
    return d.select("event", "contig", (F.col("at") + 1).alias("pos"), F.when(usable, F.col("v.ref")).alias("ref"), F.when(usable, F.col("v.alt")).alias("alt"), F.col("hap").alias("haplotype"), "codon", "wt_aa", "consequence", problems.alias("problems"))
