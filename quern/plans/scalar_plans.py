"""Scalar functions on part names, prices and texts. Bases are drawn from md5 texts:
0-3 as A, 4-7 as C, 8-b as G and c-f as T."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..functions import sequence as sq
from ._dealt import dealt
from .registry import query

_DNA_SQL = "translate(md5(CAST(p_partkey AS VARCHAR)) || md5('x' || p_partkey), '0123456789abcdef', 'AAAACCCCGGGGTTTT')"
_P = f"p AS (SELECT p_partkey, {_DNA_SQL} AS dna, p_size, p_retailprice, p_name, p_brand, p_type FROM part)"


def _dna(t):
    k = F.col("p_partkey").cast("string")
    return t.part.withColumn("dna", F.translate(F.concat(F.md5(k), F.md5(F.concat(F.lit("x"), k))), "0123456789abcdef", "AAAACCCCGGGGTTTT"))


@query(f"WITH {_P} SELECT p_partkey, reverse(translate(dna, 'ACGTN', 'TGCAN')) AS rc FROM p")
def f1_reverse_complement(t):
    return _dna(t).select("p_partkey", sq.reverse_complement(F.col("dna")).alias("rc"))


@query("SELECT p_partkey, translate(p_name, 'RYSWKMBDHVryswkmbdhv', repeat('N', 20)) AS masked FROM part")
def f2_mask_ambiguous(t):
    return t.part.select("p_partkey", sq.mask_ambiguous(F.col("p_name")).alias("masked"))


_CODONS = "codons AS (SELECT a || b || c AS codon, substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', i * 16 + j * 4 + k + 1, 1) AS aa FROM (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) x(a, i), (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) y(b, j), (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) z(c, k))"


@query(f"WITH {_P}, {_CODONS}, e AS (SELECT p_partkey, k, substr(dna, k * 3 + 1, 3) AS codon FROM p, unnest(range(0, 21)) u(k)) SELECT p_partkey, string_agg(aa, '' ORDER BY k) AS protein FROM e JOIN codons USING (codon) GROUP BY 1")
def f3_codon_translation(t):
    return dealt(_dna(t).select("p_partkey", "dna")).select("p_partkey", sq.translate(F.col("dna")).alias("protein"))


@query(f"WITH {_P} SELECT p_partkey, length(regexp_replace(dna, '[^GC]', '', 'g')) / length(dna)::DOUBLE AS gc FROM p")
def f4_gc_fraction(t):
    return _dna(t).select("p_partkey", sq.gc_fraction(F.col("dna")).alias("gc"))


@query(f"WITH {_P}, x AS (SELECT p_partkey, substr(dna, 1, 1) AS b, substr(dna, 2, 1) AS r, substr(dna, 3, 1) AS a, substr(dna, 4, 1) AS q FROM p) SELECT p_partkey, CASE WHEN r IN ('A', 'G') THEN translate(a, 'ACGT', 'ACGT') || '' ELSE a END AS after_, CASE WHEN r IN ('A', 'G') THEN translate(a, 'ACGT', 'TGCA') || '[' || translate(r, 'ACGT', 'TGCA') || '>' || translate(q, 'ACGT', 'TGCA') || ']' || translate(b, 'ACGT', 'TGCA') ELSE b || '[' || r || '>' || q || ']' || a END AS channel FROM x WHERE r <> q")
def f5_substitution_channel(t):
    d = _dna(t).select("p_partkey", *[F.substring("dna", i + 1, 1).alias(c) for i, c in enumerate("brag")])
    d = d.where("r <> g")
    return d.select("p_partkey", F.col("a").alias("after_"), sq.substitution_channel(F.col("r"), F.col("g"), F.col("b"), F.col("a")).alias("channel"))


@query(f"WITH {_P} SELECT p_partkey, len(list_distinct(list_transform(range(1, 57), lambda i: substr(dna, CAST(i AS BIGINT), 9)))) AS n FROM p")
def f7_kmers(t):
    return _dna(t).select("p_partkey", F.size(sq.kmers(F.col("dna"), 9)).cast("long").alias("n"))


@query("WITH w AS (SELECT p_partkey, substr(p_name, CAST(i + 1 AS BIGINT), n) AS x FROM part, (VALUES (4), (5)) v(n), unnest(range(0, 5)) u(i) WHERE i >= 4 - n + 1 AND i + n <= length(p_name)) SELECT p_partkey, string_agg(x, '|' ORDER BY x) AS peptides FROM (SELECT DISTINCT p_partkey, x FROM w WHERE x NOT LIKE '%X%' AND x NOT LIKE '%*%') GROUP BY 1")
def f8_spanning_peptides(t):
    p = F.array_sort(sq.spanning_peptides(F.col("p_name"), F.lit(4), 1, (4, 5)))
    return t.part.select("p_partkey", F.array_join(p, "|").alias("peptides")).where("peptides <> ''")


@query(f"WITH {_P}, {_CODONS}, e AS (SELECT p_partkey, f, k, substr(dna, k * 3 + f + 1, 3) AS codon FROM p, unnest(range(0, 3)) w(f), unnest(range(0, 21)) u(k) WHERE k * 3 + f + 3 <= 64), s AS (SELECT p_partkey, f, string_agg(aa, '' ORDER BY k) AS protein FROM e JOIN codons USING (codon) GROUP BY ALL), o AS (SELECT p_partkey, f, i, regexp_extract(x, 'M.*') AS orf FROM (SELECT p_partkey, f, unnest(range(0, len(parts))) AS i, unnest(parts) AS x FROM (SELECT p_partkey, f, string_split(protein, '*') AS parts FROM s))), b AS (SELECT p_partkey, orf, row_number() OVER (PARTITION BY p_partkey ORDER BY length(orf) DESC, f, i) AS rn FROM o) SELECT p_partkey, CASE WHEN length(orf) >= 3 THEN orf END AS orf FROM b WHERE rn = 1")
def f9_longest_orf(t):
    return dealt(_dna(t).select("p_partkey", "dna")).select("p_partkey", sq.longest_orf(F.col("dna"), 3).alias("orf"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'p.' || substr(p_name, 1, 1) || p_size || substr(p_brand, 1, 1) WHEN p_size < 20 THEN 'p.' || substr(p_name, 1, 1) || p_size || '*' WHEN p_size < 30 THEN 'p.' || substr(p_name, 1, 1) || p_size || 'fs' ELSE 'p.=' END AS change FROM part")
def f10_change_text(t):
    a, n = F.substring("p_name", 1, 1), F.col("p_size").cast("string")
    head = F.concat(F.lit("p."), a, n)
    return t.part.select("p_partkey", F.when(F.col("p_size") < 10, F.concat(head, F.substring("p_brand", 1, 1))).when(F.col("p_size") < 20, F.concat(head, F.lit("*"))).when(F.col("p_size") < 30, F.concat(head, F.lit("fs"))).otherwise("p.=").alias("change"))


@query(f"WITH {_P} SELECT p_partkey, substr(dna, greatest(1, p_size - 9), least(64, p_size + 9) - greatest(1, p_size - 9) + 1) AS window_ FROM p")
def f11_window_slice(t):
    low, high = F.greatest(F.lit(1), F.col("p_size") - 9), F.least(F.lit(64), F.col("p_size") + 9)
    return _dna(t).select("p_partkey", F.substring(F.col("dna"), low, high - low + 1).alias("window_"))


@query("SELECT p_partkey, 'chr' || p_size AS chrom, p_partkey AS pos, substr(p_name, 1, 1) AS ref, substr(p_brand, 1, 2) AS alt FROM part")
def f12_variant_parse(t):
    text = F.concat(F.lit("chr"), F.col("p_size").cast("string"), F.lit(":"), F.col("p_partkey").cast("string"), F.substring("p_name", 1, 1), F.lit(">"), F.substring("p_brand", 1, 2))
    return t.part.select("p_partkey", sc.parse_variant(text).alias("v")).select("p_partkey", "v.chrom", "v.pos", "v.ref", "v.alt")


@query("SELECT p_partkey, p_name AS chrom, CAST(p_size AS BIGINT) AS start, CAST(p_size + 10 AS BIGINT) AS \"end\" FROM part")
def f13_region_parse(t):
    text = F.concat(F.col("p_name"), F.lit(":"), F.col("p_size").cast("string"), F.lit("-"), (F.col("p_size") + 10).cast("string"))
    part = lambda i: F.regexp_extract(text, r"^(.*):(\d+)-(\d+)$", i)
    return t.part.select("p_partkey", part(1).alias("chrom"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end"))


@query("SELECT page_id, string_split(string_split(url, '?')[1], '.')[1] AS head FROM pages")
def f14_strip_version(t):
    return t.pages.select("page_id", sc.unversioned(F.substring_index("url", "?", 1)).alias("head"))


@query("SELECT o_orderkey, regexp_replace(o_orderkey || '/' || (1 + o_orderkey % 3), '/[12]$', '') AS name FROM orders")
def f15_mate_suffix(t):
    return t.orders.select("o_orderkey", sc.without_mate(F.concat(F.col("o_orderkey").cast("string"), F.lit("/"), (F.col("o_orderkey") % 3 + 1).cast("string"))).alias("name"))


@query("SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM pages")
def f16_slug(t):
    return t.pages.select("page_id", sc.slug(F.col("url")).alias("slug"))


@query("SELECT c_custkey, regexp_replace(c_name, '#', '#new-') AS name FROM customer")
def f17_infix(t):
    return t.customer.select("c_custkey", sc.infix(F.col("c_name"), "#", "new-").alias("name"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, pow(10, -l_quantity / 10) AS p, CAST(greatest(1, least(93, l_quantity - 7)) AS BIGINT) AS q FROM lineitem")
def f18_phred(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.pow(F.lit(10.0), -q / 10).alias("p"), sq.shift_phred(F.array(q), 7)[0].cast("long").alias("q"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 0 THEN CAST(greatest(0, least(59, floor((log10(o_totalprice) - 3) / 0.05))) AS BIGINT) END AS bin FROM orders")
def f19_log_bins(t):
    return t.orders.select("o_orderkey", sc.log_bin(F.col("o_totalprice"), 3, 0.05, 60).alias("bin"))


@query("SELECT o_orderkey, CAST(greatest(0, least(19, floor(o_totalprice / 25000))) AS BIGINT) AS bin FROM orders")
def f20_linear_bins(t):
    return t.orders.select("o_orderkey", sc.linear_bin(F.col("o_totalprice"), 0, 25000, 20).alias("bin"))


@query("SELECT c_custkey, substr(md5(c_name), 1, 12) AS m, sha256(c_name) AS s FROM customer")
def f21_hashes(t):
    return t.customer.select("c_custkey", F.substring(F.md5("c_name"), 1, 12).alias("m"), F.sha2("c_name", 256).alias("s"))


@query("SELECT event_id, strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day FROM events")
def f22_times(t):
    return t.events.select("event_id", F.date_format(F.expr("ts + INTERVAL '90' MINUTE"), "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.expr("datediff(cast(ts as date), date'2024-01-01')").alias("day"))


@query(f"WITH {_P}, r AS (SELECT p_partkey, dna, CASE p_partkey % 3 WHEN 0 THEN dna WHEN 1 THEN reverse(translate(dna, 'ACGT', 'TGCA')) ELSE md5('z') END AS target FROM p) SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'same' WHEN 1 THEN 'opposite' ELSE 'unknown' END AS orientation FROM r")
def f23_probe_orientation(t):
    k, dna = F.col("p_partkey") % 3, F.col("dna")
    target = F.when(k == 0, dna).when(k == 1, F.reverse(F.translate(dna, "ACGT", "TGCA"))).otherwise(F.md5(F.lit("z")))
    return _dna(t).select("p_partkey", sq.probe_orientation(dna, target).alias("orientation"))


@query("SELECT p_partkey, upper(p_name) AS family, CAST(p_size AS BIGINT) AS size FROM part")
def f24_token_parse(t):
    token = F.concat(F.lit("<"), F.upper("p_name"), F.lit(":"), F.col("p_size").cast("string"), F.lit(">"))
    part = lambda i: F.regexp_extract(token, "^<(.+):([0-9]+)>$", i)
    return t.part.select("p_partkey", part(1).alias("family"), part(2).cast("long").alias("size"))


@query("SELECT o_orderkey, 'S' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '_L00' || (1 + o_orderkey % 4) || '_R1_001.fastq.gz' AS file FROM orders")
def f25_file_names(t):
    return t.orders.select("o_orderkey", F.format_string("S%06d_L00%d_R1_001.fastq.gz", F.col("o_custkey"), F.col("o_orderkey") % 4 + 1).alias("file"))


@query("SELECT p_partkey, 3 AS n_skip, 3 AS n_retain, p_size + 300 + 5 AS cryptic_end, p_size + 150 AS novel_start FROM part")
def f26_exon_edits(t):
    s = F.col("p_size")
    exons = F.array(*[F.struct((s + 100 * i).alias("start"), (s + 100 * i + (50 if i < 3 else 0)).alias("end")) for i in range(4)])
    d = t.part.withColumn("e", exons)
    return d.select("p_partkey", F.size(sq.skip_exon(F.col("e"), 1)).alias("n_skip"), F.size(sq.retain_intron(F.col("e"), 1)).alias("n_retain"), sq.cryptic_site(F.col("e"), 3, 5)[3]["end"].alias("cryptic_end"), sq.novel_exon(F.col("e"), s + 150, s + 160)[2]["start"].alias("novel_start"))


@query("SELECT p_partkey, upper(substr(p_name, 1, 5)) || 'TT' AS bases FROM part")
def f27_pileup_cleaning(t):
    text = F.concat(F.lit("^]"), F.substring("p_name", 1, 5), F.lit("+2ac$-1g+12acgtacgtacgtt-100"), F.repeat(F.lit("n"), 100), F.lit("t"))
    return t.part.select("p_partkey", sc.clean_pileup(text).alias("bases"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) + 5 AS aligned, 2 AS inserted, CAST(l_linenumber AS BIGINT) AS deleted, round(1 - 3 / (l_quantity + 5), 9) AS identity FROM lineitem")
def a25_cigar_sums(t):
    cigar = F.concat(F.lit("5S"), F.col("l_quantity").cast("int").cast("string"), F.lit("M2I"), F.col("l_linenumber").cast("string"), F.lit("D5M"))
    d = t.lineitem.withColumn("c", cigar)
    a = sq.cigar_sum(F.col("c"), "M=X")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", a.alias("aligned"), sq.cigar_sum(F.col("c"), "I").cast("int").alias("inserted"), sq.cigar_sum(F.col("c"), "D").alias("deleted"), F.round(1 - F.lit(3) / a, 9).alias("identity"))


@query("SELECT p_partkey, CASE WHEN p_retailprice IS NULL THEN 'na' WHEN p_retailprice <= 950 THEN 'strong' WHEN p_retailprice <= 1000 THEN 'weak' ELSE 'non' END AS tier FROM part")
def p4_inclusive_tiers(t):
    return t.part.select("p_partkey", sc.tier(F.col("p_retailprice"), [950, 1000], ["strong", "weak", "non"], inclusive=True).alias("tier"))


@query("SELECT event_id, CASE WHEN value < 0.5 THEN 'T0' WHEN value < 3 THEN 'T1' WHEN value < 30 THEN 'T10' WHEN value < 300 THEN 'T100' ELSE 'T1000' END AS tier FROM events")
def p5_expression_tiers(t):
    return t.events.select("event_id", sc.tier(F.col("value"), [0.5, 3, 30, 300], ["T0", "T1", "T10", "T100", "T1000"], missing=None).alias("tier"))


@query("SELECT page_id, 'id=' || page_id || CASE WHEN url LIKE '%?%' THEN ';query=' || string_split(url, '?')[2] ELSE '' END AS info FROM pages WHERE NOT url LIKE '%?'")
def p14_key_value_text(t):
    q = F.when(F.contains("url", F.lit("?")), F.split("url", r"\?")[1])
    return t.pages.where("url not like '%?'").select("page_id", sc.key_values(id=F.col("page_id"), query=q).alias("info"))
