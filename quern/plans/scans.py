"""Readers and writers on lines made from the tables: what a reader makes of a written
line must be what the table had."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..functions.scalar import key_values
from ..operators.intervals import point_join
from ..operators.sets import union_of_keys
from ..sources import folders, readers, writers
from .registry import query


@query("SELECT c_custkey, c_name, nullif(c_mktsegment, '') AS c_mktsegment FROM customer")
def s1_typed_fields(t):
    d = t.customer.select(writers.text_of("c_custkey", "c_name", "c_mktsegment").alias("value"))
    return readers.fields(d, [("c_custkey", "long"), ("c_name", "string"), ("c_mktsegment", "string")])


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, nullif(c_mktsegment, '') AS c_mktsegment FROM customer")
def s1_header_table(t):
    """Written with a header, gzipped, and read back as texts; a missing file adds nothing."""
    path, schema = folders.scratch(t.spark, "table"), "c_custkey string, c_name string, c_mktsegment string"
    writers.write_table(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path, gzip=True)
    return readers.table(t.spark, path, schema).unionByName(readers.table(t.spark, f"{path}-missing", schema))


@query("SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents")
def s3_line_scan(t):
    return t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


@query("SELECT event_type || ' ' || event_id AS value FROM events WHERE event_id % 7 <> 0")
def s3_comment_skipping(t):
    path = folders.scratch(t.spark, "comments")
    mark = F.when(F.col("event_id") % 7 == 0, "# ").otherwise("")
    t.events.select(F.concat(mark, "event_type", F.lit(" "), F.col("event_id").cast("string")).alias("value")).write.text(path)
    return readers.lines(t.spark, path, skip="#")


@query("SELECT 'p' || l_partkey AS chrom, CAST(l_linenumber AS BIGINT) AS start, CAST(l_linenumber AS BIGINT) + 10 AS \"end\", l_returnflag AS name FROM lineitem")
def s4_interval_lines(t):
    value = writers.text_of(F.concat(F.lit("p"), F.col("l_partkey").cast("string")), "l_linenumber", F.col("l_linenumber") + 10, "l_returnflag")
    return readers.intervals(t.lineitem.select(value.alias("value")))


@query("SELECT 'T' || l_orderkey AS transcript_id, CAST(count(*) AS INTEGER) AS exons, CAST(min(l_linenumber) AS BIGINT) AS first_start FROM lineitem GROUP BY 1")
def s5_annotation(t):
    info = F.concat(F.lit('gene_name "G"; transcript_id "T'), F.col("l_orderkey").cast("string"), F.lit('";'))
    value = writers.text_of(F.lit("c"), F.lit("s"), F.lit("exon"), "l_linenumber", F.col("l_linenumber") + F.col("l_partkey"), F.lit("."), F.lit("+"), F.lit("."), info)
    return readers.transcripts(t.lineitem.select(value.alias("value"))).select("transcript_id", F.size("exons").alias("exons"), F.col("exons")[0]["start"].alias("first_start"))


@query("SELECT 'T' || l_orderkey AS transcript_id, CAST(count(*) AS INTEGER) AS exons, CAST(min(l_linenumber) AS BIGINT) AS first_start FROM lineitem GROUP BY 1")
def s6_annotation_cache(t):
    """Built once: what is read the second time is the table that the first time wrote."""
    path = folders.scratch(t.spark, "cache")

    def again():
        raise AssertionError("the cache was not used")

    readers.cached(t.spark, path, lambda: s5_annotation(t))
    return readers.cached(t.spark, path, again)


@query("SELECT o_orderkey AS pos, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS a, CAST(o_orderkey % 2 AS INTEGER) AS b, o_orderstatus = 'F' AS phased FROM orders WHERE o_orderstatus <> 'P'")
def s7_variant_lines(t):
    gt = F.when(F.col("o_orderstatus") == "P", "./.").when(F.col("o_orderstatus") == "F", F.concat(F.lit("0|"), (F.col("o_orderkey") % 2).cast("string"))).otherwise(F.concat(F.lit("1/"), (F.col("o_orderkey") % 2).cast("string")))
    value = writers.text_of(F.lit("chr1"), "o_orderkey", F.lit("."), F.lit("A"), F.lit("C"), F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT:X"), F.concat(gt, F.lit(":9")))
    return readers.variants(t.orders.select(value.alias("value"))).select("pos", "a", "b", "phased")


@query("SELECT p_partkey, substr(p_name, greatest(0, p_size - 20) + 1, greatest(0, least(length(p_name), p_size - 10) - greatest(0, p_size - 20))) AS part FROM part")
def s9_clamped_window(t):
    return t.part.select("p_partkey", readers.window(F.col("p_name"), F.col("p_size") - 20, F.col("p_size") - 10).alias("part"))


_SEQ = "regexp_replace(upper(md5(p_name) || md5(p_name) || md5(p_name)), '[^ACGTN]', 'N', 'g')"


@query(f"SELECT p_partkey, substr(seq, greatest(0, p_size - 20) + 1, greatest(0, least(96, p_size + 70) - greatest(0, p_size - 20))) AS part FROM (SELECT p_partkey, p_size, {_SEQ} AS seq FROM part)")
def s9_sequence_access(t):
    """Sequences in lines of 60 letters, read back by name; windows clamped to them."""
    path, m = folders.scratch(t.spark, "sequences"), F.md5("p_name")
    t.part.select(writers.fasta(F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(" of part")), F.concat(m, m, m)).alias("value")).write.text(path)
    seq = readers.sequences(readers.ordered_lines(t.spark, path))
    own = t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"), "p_partkey", "p_size")
    return own.join(seq, "name").select("p_partkey", readers.window(F.col("seq"), F.col("p_size") - 20, F.col("p_size") + 70).alias("part"))


@query("SELECT 'r' || o_orderkey AS name, md5('' || o_orderkey) AS seq, repeat('I', 32) AS qual, true AS whole FROM orders UNION ALL SELECT 'cut', 'ACGT', NULL, false")
def s10_four_line_records(t):
    """Records of four lines, named up to the first space; one that is cut off is a row too."""
    path, k = folders.scratch(t.spark, "reads"), F.col("o_orderkey").cast("string")
    t.orders.select(writers.fastq(F.concat(F.lit("r"), k, F.lit(" x")), F.md5(k), F.repeat(F.lit("I"), 32)).alias("value")).write.text(f"{path}/whole")
    t.spark.range(1).select(F.lit("@cut\tx\nACGT").alias("value")).write.text(f"{path}/cut")
    parts = [readers.reads(readers.ordered_lines(t.spark, f"{path}/{p}")) for p in ("whole", "cut")]
    return parts[0].union(parts[1]).select("name", "seq", "qual", "whole")


@query("SELECT 'r' || o_orderkey AS name, CAST(o_orderkey % 4096 AS INTEGER) AS flag, o_custkey AS NM FROM orders")
def s11_alignment_lines(t):
    value = writers.text_of(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")), F.col("o_orderkey") % 4096, F.lit("chr1"), F.lit(5), F.lit(60), F.lit("10M"), F.lit("*"), F.lit(0), F.lit(0), F.lit("ACGT"), F.lit("IIII"), F.concat(F.lit("NM:i:"), F.col("o_custkey").cast("string")))
    return readers.alignments(t.orders.select(value.alias("value")), "NM").select("name", "flag", "NM")


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -1 ELSE coalesce(CAST(json_extract(props, '$.k') AS INTEGER), -1) END AS k FROM events")
def s12_json(t):
    """A document that does not parse has the default."""
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    return t.events.select("event_id", readers.parsed(text, "k int", {"k": -1})["k"].alias("k"))


@query("SELECT 'regions.' || (row_number() OVER (ORDER BY r_regionkey) - 1) AS key, r_name AS value FROM region UNION ALL SELECT 'limits.rows', '3' UNION ALL SELECT 'limits.strict', 'true'")
def s13_configuration(t):
    """Settings of a YAML file, as keys with dots."""
    path = folders.scratch(t.spark, "settings")
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))), lambda x: F.concat(F.lit("  - "), x["r_name"])), "\n")
    t.region.agg(F.concat(F.lit("# settings\nlimits:\n  rows: 3\n  strict: true\nregions:\n"), names).alias("value")).write.text(path)

    def flat(x, key=""):
        for k, v in x.items() if isinstance(x, dict) else enumerate(x):
            yield from flat(v, f"{key}{k}.") if isinstance(v, (dict, list)) else [(f"{key}{k}", str(v).lower() if isinstance(v, bool) else str(v))]

    return t.spark.createDataFrame(list(flat(readers.config(t.spark, path))), "key string, value string")


@query("SELECT alias, p_partkey FROM (SELECT alias, p_partkey, row_number() OVER (PARTITION BY alias ORDER BY own, p_partkey) AS rn FROM (SELECT 'ENST' || p_size || '.' || (p_partkey % 3) AS alias, p_partkey, 0 AS own FROM part UNION ALL SELECT 'ENST' || p_size, p_partkey, 1 FROM part)) WHERE rn = 1")
def s17_alias_expansion(t):
    d = t.part.select("p_partkey", F.concat(F.lit("ENST"), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 3).cast("string")).alias("id"))
    return readers.aliases(d, "id", ["p_partkey"]).select("alias", "p_partkey")


@query("SELECT p_brand AS id, CAST(p_size AS DOUBLE) AS tpm FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1")
def s18_later_row_wins(t):
    """A value found by its column's name, under the id without its version; the last line counts."""
    path = folders.scratch(t.spark, "values")
    d = t.part.select(F.col("p_partkey").alias("o"), writers.text_of("p_name", F.concat("p_brand", F.lit("."), F.col("p_partkey").cast("string")), "p_size").alias("value"))
    head = t.spark.range(1).select(F.lit(-1).cast("long").alias("o"), F.lit("name\tgene_id\tTPM").alias("value"))
    writers.write_lines(head.union(d), path, ["o"])
    rows = readers.by_header(readers.ordered_lines(t.spark, path), ["gene_id", "TPM"])
    return rows.groupBy(sc.unversioned(F.col("gene_id")).alias("id")).agg(F.max_by("TPM", "ordinal").cast("double").alias("tpm"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN 'chr' || o_custkey END AS source, CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END END AS strand, CASE WHEN o_orderkey % 9 <> 0 THEN 5::BIGINT END AS start, CASE WHEN o_orderkey % 9 <> 0 THEN 9::BIGINT END AS \"end\" FROM orders")
def s20_header_parse(t):
    text = F.concat(F.lit("x chr"), F.col("o_custkey").cast("string"), F.lit(","), F.when(F.col("o_orderkey") % 2 == 0, "+strand").otherwise("-strand"), F.lit(",5-9"))
    text = F.when(F.col("o_orderkey") % 9 == 0, "x junk_seq length=9").otherwise(text)
    return t.orders.select("o_orderkey", readers.simulated_source(text).alias("s")).select("o_orderkey", "s.*")


@query("SELECT c_custkey AS key, c_mktsegment AS segment, NULL::BIGINT AS supplier FROM customer UNION ALL SELECT NULL, NULL, s_suppkey FROM supplier")
def k1_union_of_keys(t):
    return union_of_keys(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")), t.supplier.select(F.col("s_suppkey").alias("supplier")))


@query("SELECT n_nationkey || chr(9) || n_name || chr(9) || n_regionkey AS value FROM nation")
def k2_fixed_columns(t):
    return t.nation.select(writers.text_of("n_nationkey", "n_name", "n_regionkey").alias("value"))


@query("SELECT 'chr' || (1 + p_size % 22) || chr(9) || p_partkey || chr(9) || '.' || chr(9) || 'A' || chr(9) || 'C' || chr(9) || '.' || chr(9) || 'PASS' || chr(9) || 'brand=' || p_brand || chr(9) || 'GT:AF' || chr(9) || '0/1' AS value, CAST(1 + p_size % 22 AS INTEGER) AS chrom_rank FROM part")
def k4_variant_lines(t):
    d = t.part.withColumn("c", F.concat(F.lit("chr"), (F.col("p_size") % 22 + 1).cast("string"))).withColumn("dot", F.lit(".")).withColumn("a", F.lit("A")).withColumn("b", F.lit("C"))
    return d.select(writers.variant_line("c", "p_partkey", "dot", "a", "b", key_values(brand=F.col("p_brand")), F.lit("0/1")).alias("value"), writers.karyotypic(F.col("c")).alias("chrom_rank"))


@query("SELECT p_partkey, '>' || p_partkey || chr(10) || substr(md5(p_name) || md5(p_name) || md5(p_name), 1, 60) || chr(10) || substr(md5(p_name) || md5(p_name) || md5(p_name), 61, 36) AS value FROM part")
def k5_fasta(t):
    m = F.md5("p_name")
    return t.part.select("p_partkey", writers.fasta(F.col("p_partkey").cast("string"), F.concat(m, m, m)).alias("value"))


@query("SELECT p_partkey, '@r' || p_partkey || chr(10) || md5(p_name) || chr(10) || '+' || chr(10) || repeat('I', 32) AS value FROM part")
def k6_fastq(t):
    return t.part.select("p_partkey", writers.fastq(F.concat(F.lit("r"), F.col("p_partkey").cast("string")), F.md5("p_name"), F.repeat(F.lit("I"), 32)).alias("value"))


@query("SELECT '{\"flag\":\"' || l_returnflag || '\",\"n\":' || count(*) || '}' AS value FROM lineitem GROUP BY l_returnflag")
def k8_json_report(t):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n")).select(F.to_json(F.struct("flag", "n")).alias("value"))


@query("SELECT c_name || chr(10) || '  segment: ' || c_mktsegment || chr(10) || '  nation: ' || c_nationkey AS value FROM customer")
def k9_cards(t):
    return t.customer.select(writers.card(F.col("c_name"), segment=F.col("c_mktsegment"), nation=F.col("c_nationkey")).alias("value"))


def _bundled(name, line, key):
    """A table written as one file of lines in order of key."""
    return f"SELECT '{name}' AS \"table\", 1 AS files, CAST(sum(length({line}) + 1) AS BIGINT) AS bytes, count(*) AS rows, sha256(string_agg({line}, chr(10) ORDER BY {key}) || chr(10)) AS sha256 FROM {name}"


@query(" UNION ALL ".join([_bundled("region", "r_regionkey || chr(9) || r_name", "r_regionkey"), _bundled("nation", "n_nationkey || chr(9) || n_name", "n_nationkey")]))
def k11_bundle_manifest(t):
    paths = {}
    for name, k in (("region", "r"), ("nation", "n")):
        paths[name] = folders.scratch(t.spark, name)
        one = getattr(t, name).select(F.col(f"{k}_{name}key").alias("o"), writers.text_of(f"{k}_{name}key", f"{k}_name").alias("value"))
        one.coalesce(1).sortWithinPartitions("o").select("value").write.text(paths[name])  # a dimension: one file
    return writers.bundle(t.spark, paths).withColumn("files", F.col("files").cast("int"))


@query("SELECT o_orderkey, 'rec' || o_custkey AS record FROM orders")
def k3_truth_map(t):
    """A gzipped map from reads to records, read back."""
    path = folders.scratch(t.spark, "map")
    writers.write_table(t.orders.select("o_orderkey", F.concat(F.lit("rec"), F.col("o_custkey").cast("string")).alias("record")), path, gzip=True)
    return readers.table(t.spark, path, "o_orderkey long, record string")


@query("SELECT n_nationkey, n_name || ' (' || n_regionkey || ')' AS n_name FROM nation WHERE n_regionkey < 3")
def k10_atomic_replace(t):
    """A table replaced by what was made from itself."""
    path = folders.scratch(t.spark, "replaced")
    writers.replace(t.nation.select("n_nationkey", "n_name", "n_regionkey"), path)
    old = t.spark.read.parquet(path)
    writers.replace(old.where("n_regionkey < 3").select("n_nationkey", F.concat("n_name", F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(")")).alias("n_name"), "n_regionkey"), path)
    return t.spark.read.parquet(path).select("n_nationkey", "n_name")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def s2_constant_memory_scan(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT c_custkey, s_name FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey >= s_suppkey * 10 AND c_custkey < s_suppkey * 10 + 150")
def s8_region_scan(t):
    spans = t.supplier.select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") * 10).alias("start"), (F.col("s_suppkey") * 10 + 150).alias("end"), "s_name")
    points = t.customer.select(F.col("c_nationkey").alias("k"), "c_custkey", F.col("c_custkey").alias("pos"))
    return point_join(points, spans, ["k"], width=150).select("c_custkey", "s_name")


@query("SELECT row_number() OVER (ORDER BY event_id) - 1 AS ordinal, event_id || ':' || event_type AS value FROM events ORDER BY event_id LIMIT 400")
def s14_head_sample(t):
    """The first hundred records of four lines of a file."""
    path = folders.scratch(t.spark, "head")
    writers.write_lines(t.events.select("event_id", F.concat_ws(":", F.col("event_id").cast("string"), "event_type").alias("value")), path, ["event_id"])
    return readers.first_lines(t.spark, path, 400)


@query("SELECT 'r_regionkey=' || r_regionkey AS name FROM region WHERE r_regionkey <> 2")
def s15_discovery_with_exclusions(t):
    """The second pattern is the fallback; one folder is left out."""
    path = folders.scratch(t.spark, "found")
    t.region.write.partitionBy("r_regionkey").parquet(path)
    names = readers.discover(t.spark, [f"{path}/merged-*", f"{path}/r_regionkey=*"], without="=2$")
    return t.spark.createDataFrame([(n.rsplit("/", 1)[1],) for n in names], "name string")


@query("SELECT DISTINCT p_brand AS entry FROM part ORDER BY 1 LIMIT 10")
def s16_line_list(t):
    path = folders.scratch(t.spark, "list")
    names = t.part.select(F.col("p_brand").alias("o"), F.concat(F.lit("\n# brand\n  "), "p_brand").alias("value")).distinct()
    writers.write_lines(names, path, ["o"])
    return readers.line_list(t.spark, path, 10)


@query("SELECT 'HLA-A*02:01' AS allele, p_name AS peptide, p_size / 10.0::DOUBLE AS rank_el, p_size / 5.0::DOUBLE AS rank_ba, p_retailprice AS affinity FROM (SELECT replace(p_name, ' ', '') AS p_name, p_size, p_retailprice FROM part)")
def s19_binding_report(t):
    cells = [F.lit("  1"), F.lit("HLA-A*02:01"), F.replace("p_name", F.lit(" "), F.lit("")), *[F.lit(str(i)) for i in range(9)], (F.col("p_size") / 10.0).cast("string"), F.lit("x"), (F.col("p_size") / 5.0).cast("string"), F.col("p_retailprice").cast("string"), F.lit("<= SB")]
    d = t.part.select(F.explode(F.array(F.concat_ws("   ", *cells), F.lit("# header"), F.lit("-----"), F.lit("1 HLA-A short"))).alias("value"))
    return readers.binding_scores(d)


@query("SELECT CAST(sum(l_quantity) AS BIGINT) AS bases, CAST(sum(l_quantity * l_linenumber) AS BIGINT) AS covered, sum(l_quantity * l_linenumber) / sum(l_quantity) AS depth FROM lineitem")
def s19_captured_depth(t):
    q, start = F.col("l_quantity").cast("long"), F.col("l_orderkey")
    lines = t.lineitem.select(F.explode(F.array(writers.text_of(F.lit("chr1"), start, start + q, q * F.col("l_linenumber")), F.lit("chr1\t5"))).alias("value"))
    return readers.captured_depth(lines)


@query("SELECT 'r' || o_orderkey AS name, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders")
def s19_drawn_strands(t):
    k = F.col("o_orderkey")
    head = F.concat_ws("\t", F.lit(">chr1"), F.concat(F.lit("r"), k.cast("string")), F.lit("17"), F.when(k % 2 == 0, "+").otherwise("-"))
    return readers.drawn_strands(t.orders.select(F.explode(F.array(head, F.lit("ACGT-"), F.lit("AC-TA"))).alias("value")))


@query("SELECT p_partkey, p_size AS depth, CAST(len(regexp_extract_all(p_name, '[aeiou]')) AS BIGINT) AS alt FROM part")
def s19_pileup_lines(t):
    value = writers.text_of(F.lit("chr1"), "p_partkey", F.lit("N"), "p_size", "p_name")
    d = readers.fields(t.part.select(value.alias("value")), [("chrom", "string"), ("p_partkey", "long"), ("ref", "string"), ("depth", "int"), ("bases", "string")])
    return d.select("p_partkey", "depth", F.regexp_count("bases", F.lit("[aeiou]")).cast("long").alias("alt"))


@query("SELECT r_regionkey AS key, CASE WHEN r_regionkey % 2 = 0 THEN 'reads' ELSE 'other' END AS class, md5(r_name || chr(10)) AS md5, r_regionkey < 3 AS durable, true AS complete FROM region")
def k12_input_manifest(t):
    """Files in folders that say how long they are kept and what they are."""
    path = folders.scratch(t.spark, "inputs")
    d = t.region.select(F.col("r_name").alias("value"), F.when(F.col("r_regionkey") < 3, "release").otherwise("tmp").alias("tier"), F.when(F.col("r_regionkey") % 2 == 0, "fastq").otherwise("bed").alias("kind"), F.col("r_regionkey").alias("key"))
    d.coalesce(1).write.partitionBy("tier", "kind", "key").text(path)
    m = writers.inputs(t.spark, path, {"reads": "kind=fastq", "alignments": "kind=bam"}, "tier=release")
    return m.select(F.regexp_extract("path", "key=([0-9]+)", 1).cast("long").alias("key"), "class", "md5", "durable", "complete")
