"""Readers: header tables, intervals, annotation, variants, sequences, reads, JSON.

A missing file is an empty table with the schema asked for; checks downstream fail on
tables that are empty, so that absence never passes. Nothing is read on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_pileup


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def table(spark: SparkSession, path: str, schema: str, sep: str = "\t", comment: str | None = None) -> DataFrame:
    """A delimited file with a header, plain or gzip; empty texts are null."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema).option("sep", sep).option("header", True).option("nullValue", "").option("enforceSchema", False)
    return (r.option("comment", comment) if comment else r).csv(path)


def lines(spark: SparkSession, path: str, skip: str | None = None) -> DataFrame:
    """value: a file's lines without empty ones and those that begin with `skip`."""
    d = spark.read.text(path).where("value <> ''")
    return d.where(~F.startswith(F.col("value"), F.lit(skip))) if skip else d


def ordered_lines(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """value, ordinal: lines with their number from 0, kept as data (Spark has no row
    order). Blocks of files are counted, a row a block is summed up, and a line's number
    is its distance from its block's first: a block is read by one task in order, and
    lines are neither sorted nor moved. first: only so many lines, of the blocks they are in."""
    d = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__s"), F.monotonically_increasing_id().alias("__m"))
    base = F.sum("__n").over(Window.orderBy("__f", "__s").rowsBetween(Window.unboundedPreceding, -1))
    blocks = d.groupBy("__f", "__s").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first")).select("__f", "__s", "__first", F.coalesce(base, F.lit(0).cast("long")).alias("__base"))
    blocks = blocks if first is None else blocks.where(F.col("__base") < first)
    out = d.join(F.broadcast(blocks), ["__f", "__s"]).select("value", (F.col("__base") + F.col("__m") - F.col("__first")).alias("ordinal"))  # a row a block
    return out if first is None else out.where(F.col("ordinal") < first)


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """value, ordinal of the first n lines in order of place: file, then line. Four
    times a number of records keeps whole records."""
    return ordered_lines(spark, path, n)


def line_list(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """entry: a file's trimmed lines that are neither empty nor comments, in order; the
    first `limit` of them. A missing file is an empty list."""
    if not exists(spark, path):
        return spark.createDataFrame([], "entry string")
    d = ordered_lines(spark, path).select(F.trim("value").alias("entry"), "ordinal").where("entry <> '' and not entry like '#%'")
    return (d if limit is None else d.orderBy("ordinal").limit(limit)).select("entry")


def by_header(df: DataFrame, names: Sequence[str], sep: str = "\t") -> DataFrame:
    """Ordered lines (value, ordinal) whose first one names the columns: names, as texts,
    wherever they stand, and ordinal. A name that the header lacks is null."""
    head = df.where("ordinal = 0").select(F.split("value", sep).alias("__head"))  # one row
    d = df.where("ordinal > 0").crossJoin(F.broadcast(head)).withColumn("__cells", F.split("value", sep))
    return d.select(*[F.when(F.array_position("__head", F.lit(n)) > 0, F.get("__cells", (F.array_position("__head", F.lit(n)) - 1).cast("int"))).alias(n) for n in names], "ordinal")


def discover(spark: SparkSession, patterns: Sequence[str], without: str | None = None) -> list[str]:
    """Paths of the first glob pattern that matches any, but for those that the regular
    expression `without` finds; no match is an empty list. Names only, on the driver."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for pattern in patterns:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        names = [x.getPath().toString() for x in p.getFileSystem(conf).globStatus(p) or []]
        names = sorted(n for n in names if not (without and re.search(without, n)))
        if names:
            return names
    return []


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at path, or what build gives, written there first."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def config(spark: SparkSession, path: str) -> dict:
    """A YAML file as a dict, on the driver: settings, not data. A missing file is empty."""
    import yaml

    if not exists(spark, path):
        return {}
    return yaml.safe_load("\n".join(r.value for r in ordered_lines(spark, path).orderBy("ordinal").collect())) or {}


def parsed(text: Column, schema: str, default: dict) -> Column:
    """A JSON text as a struct; fields that it lacks, all of them where it does not
    parse, have their default (null where none is given)."""
    got = F.from_json(text, schema)
    return F.struct(*[F.coalesce(got[name], F.lit(default.get(name))).alias(name) for name in (f.split()[0] for f in schema.split(","))])


def simulated_source(text: Column) -> Column:
    """source, strand, start, end of a simulator's read header ("... name,+strand,5-9 ...");
    null fields where it has none (junk reads)."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"([^\s,]+),([+-])strand,(\d+)-(\d+)", i), F.lit(""))
    return F.struct(part(1).alias("source"), part(2).alias("strand"), part(3).try_cast("long").alias("start"), part(4).try_cast("long").alias("end"))


def binding_scores(df: DataFrame) -> DataFrame:
    """allele, peptide and the three scores of a binding predictor's report lines (value):
    rows of 16 cells and more that begin with a number and an HLA name; others are text."""
    c = df.select(F.split(F.trim("value"), r"\s+").alias("c")).where("size(c) >= 16 and c[0] rlike '^[0-9]+$' and c[1] like 'HLA-%'")
    d = c.select(F.col("c")[1].alias("allele"), F.col("c")[2].alias("peptide"), *[F.col("c")[i].try_cast("double").alias(n) for i, n in ((12, "rank_el"), (14, "rank_ba"), (15, "affinity"))])
    return d.where("rank_el is not null and rank_ba is not null and affinity is not null")


def captured_depth(df: DataFrame) -> DataFrame:
    """bases, covered, depth of coverage lines (value: chrom, start, end, covered bases);
    shorter lines don't count; no lines give null."""
    c = df.select(F.split("value", "\t").alias("c")).where("size(c) >= 4").select((F.col("c")[2].cast("long") - F.col("c")[1].cast("long")).alias("n"), F.col("c")[3].cast("long").alias("k"))
    return c.agg(F.sum("n").alias("bases"), F.sum("k").alias("covered"), F.try_divide(F.sum("k"), F.sum("n")).alias("depth"))


def drawn_strands(df: DataFrame) -> DataFrame:
    """name, strand of a read simulator's alignment lines (value) ">reference name start strand"."""
    c = df.where("value like '>%'").select(F.split(F.trim(F.expr("substring(value, 2)")), r"\s+").alias("c")).where("size(c) >= 4")
    return c.select(F.col("c")[1].alias("name"), F.element_at("c", -1).alias("strand"))


def fields(df: DataFrame, schema: Sequence[tuple[str, str]], sep: str = "\t") -> DataFrame:
    """Columns of `value` split at sep, cast where they can be, else null."""
    parts = F.split("value", sep)
    return df.select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast(kind).alias(name) for i, (name, kind) in enumerate(schema)])


def intervals(df: DataFrame) -> DataFrame:
    """chrom, start, end (half-open, from 0), name of BED lines (value); track lines are left out."""
    d = df.where("not value rlike '^(#|track|browser)'")
    return fields(d, [("chrom", "string"), ("start", "long"), ("end", "long"), ("name", "string")]).where("start is not null and end is not null")


def attributes(column: str, *names: str) -> list[Column]:
    """Values of key "value" pairs of an annotation line, null where missing."""
    return [F.nullif(F.regexp_extract(column, f'{n} "([^"]*)"', 1), F.lit("")).alias(n) for n in names]


def transcripts(df: DataFrame) -> DataFrame:
    """Annotation lines (value) nested by transcript: transcript_id, gene_name, chrom,
    strand, exons and cds as sorted arrays of (start, end), 1-based and inclusive."""
    d = fields(df, [("chrom", "string"), ("source", "string"), ("feature", "string"), ("start", "long"), ("end", "long"), ("score", "string"), ("strand", "string"), ("frame", "string"), ("info", "string")])
    d = d.where("feature in ('exon', 'CDS')").select("*", *attributes("info", "transcript_id", "gene_name")).where("transcript_id is not null")
    span = F.struct("start", "end")
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("feature") == kind, span)))
    return d.groupBy("transcript_id", "gene_name", "chrom", "strand").agg(pick("exon").alias("exons"), pick("CDS").alias("cds"))


def variants(df: DataFrame) -> DataFrame:
    """Variant lines (value): chrom, pos, ref, alts, a, b of the first sample; rows without
    a call, or with an allele that is not listed, are left out."""
    d = fields(df.where("not value like '#%'"), [("chrom", "string"), ("pos", "long"), ("id", "string"), ("ref", "string"), ("alt", "string"), ("qual", "string"), ("filter", "string"), ("info", "string"), ("format", "string"), ("sample", "string")])
    gt = F.split(F.split("sample", ":")[0], "[/|]")
    d = d.withColumn("alts", F.split("alt", ",")).withColumn("a", F.get(gt, F.lit(0)).try_cast("int")).withColumn("b", F.coalesce(F.get(gt, F.lit(1)).try_cast("int"), F.get(gt, F.lit(0)).try_cast("int")))
    return d.where("a is not null and b is not null and a <= size(alts) and b <= size(alts)").select("chrom", "pos", "ref", "alts", "a", "b", F.contains("sample", F.lit("|")).alias("phased"))


def carried(df: DataFrame, value: Column, name: str, block: int = 65_536) -> DataFrame:
    """df (with ordinal) and the last value that is not null up to each row, in order of
    ordinal. Blocks of rows carry on their own; only one row a block meets the others."""
    d = df.withColumn("__v", value).withColumn("__b", F.floor(F.col("ordinal") / block))
    last = d.where("__v is not null").groupBy("__b").agg(F.max_by("__v", "ordinal").alias("__u"))
    ends = d.groupBy("__b").agg(F.count(F.lit(1)).alias("__n")).join(last, "__b", "left")
    before = F.last("__u", ignorenulls=True).over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select("__b", before.alias("__before"))
    within = F.last("__v", ignorenulls=True).over(Window.partitionBy("__b").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0))
    return d.join(ends, "__b").withColumn(name, F.coalesce(within, "__before")).drop("__v", "__b", "__before")


def sequences(df: DataFrame) -> DataFrame:
    """FASTA lines (value, ordinal): name and the sequence, upper case, unknown letters N."""
    head = F.when(F.col("value").startswith(">"), F.split(F.expr("substring(value, 2)"), r"\s")[0])
    d = carried(df, head, "name").where("not value like '>%'")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "value"))), lambda x: x["value"]), "")
    return d.groupBy("name").agg(F.regexp_replace(F.upper(joined), "[^ACGTN]", "N").alias("seq"))


def window(seq: Column, start: Column, end: Column) -> Column:
    """[start, end) of a sequence, from 0, clamped to it."""
    low, high = F.greatest(F.lit(0), start), F.least(F.length(seq), end)
    return F.when(high > low, F.substring(seq, low + 1, high - low)).otherwise("")


def reads(df: DataFrame) -> DataFrame:
    """FASTQ lines (value, ordinal): ordinal, name (to the first space), seq, qual, whole.
    whole is false where a record lacks lines or marks: truncation is data, not a crash."""
    d = df.withColumn("record", F.floor(F.col("ordinal") / 4)).withColumn("part", F.col("ordinal") % 4)
    part = lambda i: F.max(F.when(F.col("part") == i, F.col("value")))
    d = d.groupBy("record").agg(part(0).alias("head"), part(1).alias("seq"), part(2).alias("plus"), part(3).alias("qual"), F.count(F.lit(1)).alias("n"))
    whole = (F.col("n") == 4) & F.col("head").startswith("@") & F.col("plus").startswith("+")
    return d.select(F.col("record").alias("ordinal"), F.split(F.expr("substring(head, 2)"), r"\s")[0].alias("name"), "seq", "qual", whole.alias("whole"))


def alignments(df: DataFrame, *tags: str) -> DataFrame:
    """SAM lines (value): name, flag, chrom, pos, mapq, cigar, seq, qual and integer tags."""
    d = df.where("not value like '@%'")
    cells = fields(d.select("value"), [("name", "string"), ("flag", "int"), ("chrom", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "long"), ("seq", "string"), ("qual", "string")])
    if not tags:
        return cells
    value = F.col("value")
    parts = F.split(value, "\t")
    base = [F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast(k).alias(n) for i, (n, k) in enumerate([("name", "string"), ("flag", "int"), ("chrom", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string")])]
    return d.select(*base, *[F.nullif(F.regexp_extract(value, f"\\t{t}:i:(-?[0-9]+)", 1), F.lit("")).try_cast("long").alias(t) for t in tags])


def aliases(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows under their key and, for ENST keys, under the part before the dot; the first
    by order wins where an alias repeats."""
    short = F.split(key, r"\.")[0]
    both = df.withColumn("alias", F.explode(F.when(F.col(key).startswith("ENST"), F.array_distinct(F.array(F.col(key), short))).otherwise(F.array(F.col(key)))))
    w = Window.partitionBy("alias").orderBy((F.col("alias") != F.col(key)).cast("int"), *order)
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def sidecar_totals(spark: SparkSession, path: str, kind: str, keys: dict[str, list[str]], distinct: dict[str, str] = {}) -> DataFrame:
    """kind, sidecars, read_, bytes and a column for each entry of keys and distinct.

    Each line of the files under path (in folders kind=...) is a JSON document of some
    version. keys: sums of whole numbers, each under the first of its paths that the
    document has as a number; distinct: how many different texts a path has. read_ counts
    the lines that are JSON documents; others, and empty lines, add nothing but to
    sidecars. Bytes are the files' sizes, whatever they hold. Documents are taken as
    VARIANT, so no schema is given and none is found out by reading twice."""
    d = spark.read.text(path).select(F.col(kind).cast("string").alias(kind), F.try_parse_json(F.when(F.trim("value") != "", F.col("value"))).alias("v"), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size"))
    first = lambda paths: F.coalesce(*[F.try_variant_get("v", p, "long") for p in paths], F.lit(0))
    sums = [F.sum(first(p)).alias(name) for name, p in keys.items()]
    texts = [F.count_distinct(F.try_variant_get("v", p, "string")).alias(name) for name, p in distinct.items()]
    rows = d.groupBy(kind).agg(F.count(F.lit(1)).alias("sidecars"), F.count("v").alias("read_"), *sums, *texts)
    sizes = d.groupBy(kind, "__file").agg(F.max("__size").alias("__size")).groupBy(kind).agg(F.sum("__size").alias("bytes"))
    return rows.join(sizes, kind)


def pileup(df: DataFrame) -> DataFrame:
    """contig, pos, depth, bases of pileup lines (value): bases in upper case, without read
    starts, ends and indel texts. Lines of fewer than five fields, and those without a
    place, are left out."""
    d = df.where(F.size(F.split("value", "\t")) >= 5)
    d = fields(d, [("contig", "string"), ("pos", "long"), ("ref", "string"), ("depth", "int"), ("bases", "string")]).where("pos is not null")
    return d.select("contig", "pos", "depth", F.coalesce(clean_pileup(F.col("bases")), F.lit("")).alias("bases"))


_PAF = (("query", "string"), ("query_length", "long"), ("query_start", "long"), ("query_end", "long"), ("strand", "string"), ("target", "string"), ("target_length", "long"), ("target_start", "long"), ("target_end", "long"), ("matches", "long"), ("block", "long"), ("quality", "int"))


def pairwise_alignments(df: DataFrame) -> DataFrame:
    """The twelve fields of pairwise alignment lines (value), identity (matches a letter of
    the block), covered (the query's aligned share) and cs (the difference text of the tag
    cs:Z:, null without). Lines of fewer fields, or without a number of matches, are left out."""
    tag = F.nullif(F.regexp_extract("value", r"\tcs:Z:([^\t]*)", 1), F.lit(""))
    names = [n for n, _ in _PAF]
    parts = F.split("value", "\t")
    d = df.select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("")).try_cast(kind).alias(n) for i, (n, kind) in enumerate(_PAF)], tag.alias("cs"))
    d = d.where("query is not null and target is not null and matches is not null")
    return d.select(*names, F.try_divide("matches", "block").alias("identity"), F.try_divide(F.col("query_end") - F.col("query_start"), "query_length").alias("covered"), "cs")


def best_alignments(alignments: DataFrame) -> DataFrame:
    """Each query's alignment with the most matches (ties: by target, target_start, strand)."""
    rest = [c for c in alignments.columns if c != "query"]
    best = F.min(F.struct((-F.col("matches")).alias("__m"), F.col("target").alias("__t"), F.col("target_start").alias("__s"), F.col("strand").alias("__d"), F.struct(*rest).alias("row")))
    return alignments.groupBy("query").agg(best.alias("b")).select("query", "b.row.*")
