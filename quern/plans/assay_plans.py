"""Composite queries over reads, alignments, adapters, haplotypes and their sidecars.

Eight parts of 64 letters in a row make a contig of 512."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import functions as F

from ..functions import messagepack as mp
from ..functions import sequence as sq
from ..operators import adapters as ad
from ..operators import alignments, bundles, passengers, phasing, spikeins
from ..sources import folders, readers
from ._dealt import dealt
from .registry import query
from .scalar_plans import _CODONS, _P, _dna

_U = "(CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE)"
_CONTIGS = f"{_P}, k AS (SELECT *, p_partkey // 8 AS contig, p_partkey % 8 AS block FROM p), letters AS (SELECT contig, block * 64 + i - 1 AS spot, substr(dna, i, 1) AS letter FROM k, unnest(range(1, 65)) u(i))"


def _blocks(t):
    return dealt(_dna(t).select(F.floor(F.col("p_partkey") / 8).alias("contig"), (F.col("p_partkey") % 8).alias("block"), F.col("dna").alias("seq")))


@query(f"""WITH {_CONTIGS},
steps AS (SELECT *, CASE WHEN lag(letter) OVER w = letter AND lag(spot) OVER w = spot - 1 THEN 0 ELSE 1 END AS fresh FROM letters WINDOW w AS (PARTITION BY contig ORDER BY spot)),
numbered AS (SELECT contig, spot, sum(fresh) OVER (PARTITION BY contig ORDER BY spot) AS run FROM steps),
mask AS (SELECT contig, spot, count(*) OVER (PARTITION BY contig, run) >= 3 AS inside FROM numbered),
reads AS (SELECT l_returnflag AS flag, l_partkey // 8 AS contig, l_partkey % 8 * 64 + l_suppkey % 40 AS pos, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS n FROM lineitem),
placed AS (SELECT *, pos + q AS ins_at, pos + q + 3 AS del_at, pos + q + 3 + n % 3 AS tail FROM reads),
aligned AS (SELECT flag, contig, unnest(range(pos, del_at)) AS spot FROM placed UNION ALL SELECT flag, contig, unnest(range(tail, tail + 4)) FROM placed),
a AS (SELECT flag, coalesce(inside, false) AS inside, count(*) AS aligned FROM aligned LEFT JOIN mask USING (contig, spot) GROUP BY ALL),
ev AS (SELECT flag, contig, ins_at - 1 AS spot, 1 AS ins, 0 AS del, n AS inserted, 0 AS deleted FROM placed UNION ALL SELECT flag, contig, del_at, 0, 1, 0, n % 3 FROM placed WHERE n % 3 > 0),
e AS (SELECT flag, coalesce(inside, false) AS inside, sum(ins) AS ins, sum(del) AS del, sum(inserted) AS inserted, sum(deleted) AS deleted FROM ev LEFT JOIN mask USING (contig, spot) GROUP BY ALL),
j AS (SELECT flag, inside, coalesce(aligned, 0) AS aligned, coalesce(ins, 0) AS ins, coalesce(del, 0) AS del, coalesce(inserted, 0) AS inserted, coalesce(deleted, 0) AS deleted FROM a FULL JOIN e USING (flag, inside)),
r AS (SELECT *, (ins + del) * 1e6::DOUBLE / aligned AS rate, (inserted + deleted) * 1e6::DOUBLE / aligned AS bases FROM j)
SELECT flag, CASE WHEN inside THEN 'run' ELSE 'other' END AS context, CAST(aligned AS BIGINT) AS aligned, CAST(ins AS BIGINT) AS insertions, CAST(del AS BIGINT) AS deletions, CAST(inserted AS BIGINT) AS inserted, CAST(deleted AS BIGINT) AS deleted, 0::BIGINT AS excluded,
round(rate, 6) AS event_rate, round(bases, 6) AS base_rate, round(max(CASE WHEN inside THEN rate END) OVER (PARTITION BY flag) / max(CASE WHEN NOT inside THEN rate END) OVER (PARTITION BY flag), 6) AS enrichment FROM r""")
def c7_indels_in_runs(t):
    """Reads of q letters, an insertion, three letters, a deletion and four letters; runs of three."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    gap = F.when(n % 3 > 0, F.concat((n % 3).cast("string"), F.lit("D"))).otherwise("")
    cigar = F.concat(F.lit("2S"), q.cast("string"), F.lit("M"), n.cast("string"), F.lit("I3M"), gap, F.lit("4M"))
    reads = t.lineitem.select(F.monotonically_increasing_id().alias("read"), F.col("l_returnflag").alias("flag"), F.floor(F.col("l_partkey") / 8).alias("contig"), (F.col("l_partkey") % 8 * 64 + F.col("l_suppkey") % 40).alias("pos"), cigar.alias("cigar"))
    out = alignments.indels_in_runs(reads, ["read"], _blocks(t), 64, ["flag"], least=3)
    return out.withColumns({c: F.round(c, 6) for c in ("event_rate", "base_rate", "enrichment")})


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderkey % 11 = 0 AS cut FROM orders),
v AS (SELECT o_orderkey, 'left.label' AS path, 'str' AS kind, CAST(o_orderkey % 9 AS VARCHAR) AS text, 2 AS i, cut FROM o
UNION ALL SELECT o_orderkey, 'left.seq', 'str', md5(o_orderpriority) || o_orderpriority, 3, cut FROM o
UNION ALL SELECT o_orderkey, 'counts.0', 'int', CAST(o_custkey AS VARCHAR), 5, cut FROM o
UNION ALL SELECT o_orderkey, 'counts.1', 'int', CAST(-o_custkey * 1000003 AS VARCHAR), 6, cut FROM o
UNION ALL SELECT o_orderkey, 'counts.2', CASE WHEN o_orderkey % 2 = 0 THEN 'nil' ELSE 'bool' END, CASE WHEN o_orderkey % 2 = 1 THEN 'true' END, 7, cut FROM o
UNION ALL SELECT o_orderkey, 'raw', 'bin', md5(CAST(o_orderkey AS VARCHAR)), 8, cut FROM o WHERE NOT cut)
SELECT o_orderkey, path, kind, text, NOT cut AS whole FROM v""")
def s19_messagepack(t):
    """Orders as MessagePack bytes, every eleventh cut off within its last value, and read again."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    third = F.when(k % 2 == 0, mp.pack_flag(F.lit(None))).otherwise(mp.pack_flag(F.lit(True)))
    left = mp.pack_map(label=mp.pack_text((k % 9).cast("string")), seq=mp.pack_text(F.concat(F.md5("o_orderpriority"), "o_orderpriority")))
    value = mp.pack_map(left=left, counts=mp.pack_list(F.array(mp.pack_int(c), mp.pack_int(-c * 1000003), third)), raw=mp.pack_bytes(F.unhex(F.md5(k.cast("string")))))
    whole = mp.packed(value)
    d = dealt(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")).select("o_orderkey", mp.unpacked(F.when(k % 11 == 0, F.substring(whole, F.lit(1), F.octet_length(whole) - 3)).otherwise(whole)).alias("u"))
    return d.select("o_orderkey", "u.whole", F.explode("u.values").alias("v")).select("o_orderkey", "v.path", "v.kind", "v.text", "whole").where("kind not in ('map', 'array')")


# Four adapters of twelve letters.
_ADAPTERS = [md5(f"adapter:{k}".encode()).hexdigest()[:12].translate(str.maketrans("0123456789abcdef", "AAAACCCCGGGGTTTT")) for k in range(4)]
_A = "(VALUES " + ", ".join(f"({k}, '{a}')" for k, a in enumerate(_ADAPTERS)) + ") v(label, adapter)"
_SEGMENT = "substr(translate(md5(c_custkey || ':{k}'), '0123456789abcdef', 'AAAACCCCGGGGTTTT'), 1, CAST(5 + (c_custkey + {k}) % 9 AS BIGINT))"


def _read(k: str) -> str:
    """SQL of a customer's array: whole, turned, without an adapter, with a changed one, or out of order."""
    order = {0: (0, 1, 2, 3), 1: (0, 1, 2, 3), 2: (0, 1, 3), 3: (0, 1, 2, 3), 4: (0, 2, 1, 3)}
    cases = []
    for kind, labels in order.items():
        parts = [f"'{_ADAPTERS[labels[0]]}'"]
        for i, a in enumerate(labels[1:]):
            changed = ("T" if _ADAPTERS[a][5] != "T" else "C") if kind == 3 and a == 2 else _ADAPTERS[a][5]
            parts += [_SEGMENT.format(k=i), f"'{_ADAPTERS[a][:5] + changed + _ADAPTERS[a][6:]}'"]
        text = " || ".join(parts)
        cases.append(f"WHEN {k} % 5 = {kind} THEN " + (f"reverse(translate({text}, 'ACGT', 'TGCA'))" if kind == 1 else text))
    return "CASE " + " ".join(cases) + " END"


_READ = _read("c_custkey")


@query(f"""WITH r AS (SELECT c_custkey, {_READ} AS read FROM customer), p AS (SELECT label, turned, CASE WHEN turned THEN reverse(translate(adapter, 'ACGT', 'TGCA')) ELSE adapter END AS pattern FROM {_A}, (VALUES (false), (true)) w(turned)),
h AS (SELECT c_custkey, label, turned, stop, min(levenshtein(pattern, substr(read, s + 1, stop - s))) AS distance FROM (SELECT r.*, p.*, unnest(range(11, length(read) + 1)) AS stop FROM r, p), (VALUES (-1), (0), (1)) d(d), LATERAL (SELECT stop - 12 + d AS s) WHERE s >= 0 GROUP BY ALL HAVING distance <= 1),
b AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY c_custkey) AS n, sum(turned::INT) OVER (PARTITION BY c_custkey) * 2 > count(*) OVER (PARTITION BY c_custkey) AS back FROM h WHERE NOT EXISTS (SELECT 1 FROM h o WHERE o.c_custkey = h.c_custkey AND o.label = h.label AND o.turned = h.turned AND abs(o.stop - h.stop) < 12 AND (o.distance < h.distance OR o.distance = h.distance AND o.stop < h.stop)) WINDOW w AS (PARTITION BY c_custkey ORDER BY stop, distance, label, turned)),
f AS (SELECT *, label = lag(label) OVER w + CASE WHEN back THEN -1 ELSE 1 END AND turned = back AS follows FROM b WINDOW w AS (PARTITION BY c_custkey ORDER BY i)),
g AS (SELECT c_custkey, string_agg(label || CASE WHEN turned THEN '-' ELSE '+' END, '' ORDER BY i) AS grammar, CAST(count(*) FILTER (follows) AS INTEGER) AS segments, any_value(back) AS turned, bool_and(CASE WHEN i = 1 THEN turned = back ELSE follows END) AS whole FROM f GROUP BY 1)
SELECT r.c_custkey, coalesce(grammar, '') AS grammar, coalesce(segments, 0) AS segments, coalesce(turned, false) AS turned, CASE WHEN g.c_custkey IS NULL THEN 'none' WHEN NOT whole THEN 'broken' WHEN segments = 3 THEN 'complete' ELSE 'partial' END AS verdict FROM r LEFT JOIN g USING (c_custkey)""")
def c5_adapter_grammar(t):
    """Adapters found with one edit in customers' arrays, and what they spell."""
    d = t.customer.select("c_custkey", F.expr(_READ).alias("read"))
    g = ad.grammar(ad.adapter_hits(F.col("read"), _ADAPTERS, 1), 3)
    return d.select("c_custkey", g.alias("g")).select("c_custkey", "g.grammar", "g.segments", "g.turned", "g.verdict")


@query(f"""WITH r AS (SELECT c_custkey, {_READ} AS read FROM customer WHERE c_custkey % 5 IN (0, 1)) SELECT c_custkey, k AS segment, CASE k WHEN 0 THEN {_SEGMENT.format(k=0)} WHEN 1 THEN {_SEGMENT.format(k=1)} ELSE {_SEGMENT.format(k=2)} END AS sequence FROM r, (VALUES (0), (1), (2)) v(k)""")
def c5_segments(t):
    """The segments of whole arrays, turned ones among them."""
    d = t.customer.where("c_custkey % 5 in (0, 1)").select("c_custkey", F.expr(_READ).alias("read"))
    d = d.withColumn("hits", ad.adapter_hits(F.col("read"), _ADAPTERS, 0))
    return ad.segments(d, ["c_custkey"], "read", "hits", [12] * 4)


_SEEN = "CASE WHEN o_orderkey % 7 = 0 THEN substr({a}, 2) WHEN o_orderkey % 5 = 0 THEN substr({a}, 1, 3) || 'N' || substr({a}, 5) ELSE {a} END"


@query(f"""WITH seen AS (SELECT label, {_SEEN.format(a='adapter')} AS seq FROM (SELECT o_orderkey, unnest([o_orderkey % 3, o_orderkey % 3 + 1]) AS k FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT o_orderkey, o_orderkey % 3 FROM orders WHERE o_orderkey % 11 = 0), {_A} WHERE label = k),
full_ AS (SELECT * FROM seen WHERE length(seq) = 12), c AS (SELECT label, i, substr(seq, i, 1) AS x, count(*) AS n FROM full_, unnest(range(1, 13)) u(i) GROUP BY ALL),
b AS (SELECT label, i, arg_min(x, (-n, x)) AS x, max(n) / sum(n) AS share FROM c GROUP BY ALL)
SELECT CAST(label AS VARCHAR) AS label, string_agg(x, '' ORDER BY i) AS seq, 12 AS length, (SELECT count(*) FROM full_ f WHERE f.label = b.label) AS n, round(min(share), 9) AS worst FROM b GROUP BY label""")
def c5_adapter_consensus(t):
    """Adapters as tags tell them, some a letter short or wrong, some tags cut off."""
    k = F.col("o_orderkey") % 3
    texts = F.array(*[F.lit(a) for a in _ADAPTERS])

    def side(i):
        return mp.pack_map(label=mp.pack_text(i.cast("string")), seq=mp.pack_text(F.get(F.col("seen"), i)))

    d = dealt(t.orders.select("o_orderkey")).select("o_orderkey", F.transform(texts, lambda a: F.when(F.col("o_orderkey") % 7 == 0, F.substring(a, F.lit(2), F.lit(11))).when(F.col("o_orderkey") % 5 == 0, F.concat(F.substring(a, 1, 3), F.lit("N"), F.substring(a, F.lit(5), F.lit(8)))).otherwise(a)).alias("seen"))
    whole = mp.packed(mp.pack_map(left=side(k), right=side(k + 1)))
    tags = d.select("o_orderkey", mp.let(whole, lambda b: F.when(F.col("o_orderkey") % 11 == 0, F.substring(b, F.lit(1), F.octet_length(b) - 4)).otherwise(b)).alias("tag"))
    return ad.consensus(ad.told_adapters(tags, ["o_orderkey"], "tag")).withColumn("worst", F.round("worst", 9))


@query("WITH a AS (SELECT l_orderkey, count(*) AS segments FROM lineitem GROUP BY 1), b AS (SELECT segments, count(*) AS arrays FROM a WHERE l_orderkey NOT IN ((SELECT min(l_orderkey) FROM lineitem), (SELECT max(l_orderkey) FROM lineitem)) GROUP BY 1) SELECT segments, arrays, round(arrays / sum(arrays) OVER (), 9) AS share FROM b")
def c5_array_yield(t):
    return ad.array_yield(t.lineitem, "l_orderkey", "l_orderkey").withColumn("share", F.round("share", 9))


_SLOTS = "slots AS (SELECT l_partkey, l_orderkey % 2 AS hap, l_suppkey % 7 AS slot, min((l_orderkey, l_linenumber, l_suppkey % 3)) AS m FROM lineitem GROUP BY ALL)"


@query(f"""WITH {_CONTIGS}, {_SLOTS},
made AS (SELECT contig, hap, block * 64 + slot * 8 + 4 + m[3] AS start, CASE m[2] % 3 WHEN 0 THEN substr(dna, CAST(slot * 8 + 5 + m[3] AS BIGINT), 1) WHEN 1 THEN substr(dna, CAST(slot * 8 + 5 + m[3] AS BIGINT), CAST(1 + m[1] % 4 AS BIGINT)) ELSE '' END AS ref, m[2] % 3 AS kind, dna, slot, m FROM slots JOIN k ON p_partkey = l_partkey),
edits AS (SELECT contig, hap, start, ref, CASE kind WHEN 0 THEN translate(ref, 'ACGT', 'CGTA') WHEN 1 THEN '' ELSE 'TG' END AS alt, start + greatest(length(ref), 1) AS stop FROM made),
f AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY contig ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM edits),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY contig ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS grp FROM f),
spans AS (SELECT contig, grp, min(start) AS lo, max(stop) AS hi FROM g GROUP BY ALL),
cells AS (SELECT s.contig, grp, lo, hap, spot, letter FROM spans s JOIN letters l ON l.contig = s.contig AND spot >= lo AND spot < hi, (VALUES (0), (1)) v(hap)),
pieces AS (SELECT c.*, CASE WHEN b.start IS NOT NULL THEN b.alt || CASE WHEN b.ref = '' THEN letter ELSE '' END WHEN EXISTS (SELECT 1 FROM edits e WHERE e.contig = c.contig AND e.hap = c.hap AND c.spot > e.start AND c.spot < e.start + length(e.ref)) THEN '' ELSE letter END AS piece FROM cells c LEFT JOIN edits b ON b.contig = c.contig AND b.hap = c.hap AND b.start = c.spot),
seqs AS (SELECT contig, lo, hap, string_agg(letter, '' ORDER BY spot) AS ref, string_agg(piece, '' ORDER BY spot) AS seq FROM pieces GROUP BY ALL),
haps AS (SELECT contig, lo, any_value(ref) AS ref, max(CASE hap WHEN 0 THEN seq END) AS h0, max(CASE hap WHEN 1 THEN seq END) AS h1 FROM seqs GROUP BY ALL),
led AS (SELECT haps.*, CASE WHEN length(h0) = length(ref) AND length(h1) = length(ref) THEN '' ELSE letter END AS lead_ FROM haps LEFT JOIN letters l ON l.contig = haps.contig AND l.spot = lo - 1 WHERE h0 <> ref OR h1 <> ref)
SELECT contig, lo + 1 - length(lead_) AS pos, lead_ || ref AS ref, CASE WHEN h0 = ref THEN lead_ || h1 WHEN h1 = ref OR h1 = h0 THEN lead_ || h0 ELSE lead_ || h0 || ',' || lead_ || h1 END AS alts,
CASE WHEN h0 = ref THEN 0 ELSE 1 END AS gt0, CASE WHEN h1 = ref THEN 0 WHEN h1 = h0 OR h0 = ref THEN 1 ELSE 2 END AS gt1 FROM led""")
def d28_graft_alleles(t):
    """Substitutions, deletions and insertions of both sides of each part's letters."""
    slots = t.lineitem.groupBy("l_partkey", (F.col("l_orderkey") % 2).cast("int").alias("hap"), (F.col("l_suppkey") % 7).alias("slot")).agg(F.min(F.struct("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 3).alias("shift"))).alias("m"))
    k = _dna(t).select("p_partkey", F.floor(F.col("p_partkey") / 8).alias("contig"), (F.col("p_partkey") % 8 * 64).alias("base"), "dna")
    at, kind = F.col("slot") * 8 + 4 + F.col("m.shift"), F.col("m.l_linenumber") % 3
    size = F.when(kind == 0, 1).when(kind == 1, 1 + F.col("m.l_orderkey") % 4).otherwise(0)
    d = slots.join(k.hint("merge"), F.col("l_partkey") == F.col("p_partkey")).withColumn("ref", F.substring(F.col("dna"), (at + 1).cast("int"), size.cast("int")))
    alt = F.when(kind == 0, F.translate("ref", "ACGT", "CGTA")).when(kind == 1, "").otherwise("TG")
    edits = d.select("contig", "hap", (F.col("base") + at).alias("start"), "ref", alt.alias("alt"))
    return phasing.graft_records(edits, _blocks(t), 64).withColumn("alts", F.array_join("alts", ","))


@query(f"""WITH {_CONTIGS}, g AS (SELECT contig, string_agg(dna, '' ORDER BY block) AS h0, count(*) AS n FROM k GROUP BY 1 HAVING count(*) = 8),
s AS (SELECT contig, h0, CASE WHEN contig % 5 = 0 THEN h0 ELSE substr(h0, 1, 200) || translate(substr(h0, 201, 100), 'ACGT', 'CATG') || substr(h0, 301) END AS h1 FROM g),
a AS (SELECT contig AS locus, 'a' AS allele, contig % 3 AS d, substr(h0, 150, 200) AS seq FROM s UNION ALL SELECT contig, 'b', 1 - contig % 2, CASE WHEN contig % 7 = 0 THEN substr(h0, 400, 100) WHEN contig % 11 = 0 THEN NULL ELSE reverse(translate(substr(h1, 150, 200), 'ACGT', 'TGCA')) END FROM s WHERE contig % 4 <> 0),
declared AS (SELECT locus, allele, seq, CASE d WHEN 2 THEN '0/1' ELSE CAST(d AS VARCHAR) END AS declared FROM a), n AS (SELECT locus, count(*) AS n FROM a GROUP BY 1),
km AS (SELECT DISTINCT locus, allele, least(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT locus, allele, substr(seq, i, 21) AS x FROM a, unnest(range(1, length(seq) - 19)) u(i))),
ks AS (SELECT DISTINCT locus, hap, least(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT contig AS locus, hap, substr(CASE hap WHEN 0 THEN h0 ELSE h1 END, i, 21) AS x FROM s, (VALUES (0), (1)) v(hap), unnest(range(1, 493)) u(i))),
c AS (SELECT km.locus, allele, count(x.kmer) / count(*)::DOUBLE AS c0, count(y.kmer) / count(*)::DOUBLE AS c1 FROM km LEFT JOIN ks x ON x.locus = km.locus AND x.kmer = km.kmer AND x.hap = 0 LEFT JOIN ks y ON y.locus = km.locus AND y.kmer = km.kmer AND y.hap = 1 GROUP BY ALL),
j AS (SELECT d.locus, d.allele, declared, CASE WHEN n > 1 AND seq IS NOT NULL THEN c0 END AS c0, CASE WHEN n > 1 AND seq IS NOT NULL THEN c1 END AS c1, n, seq, h0 = h1 AS alike FROM declared d JOIN n USING (locus) JOIN s ON contig = locus LEFT JOIN c ON c.locus = d.locus AND c.allele = d.allele),
m AS (SELECT *, CASE WHEN NOT alike AND abs(c0 - c1) >= 0.02 THEN CASE WHEN c0 < c1 THEN 1 ELSE 0 END END AS measured FROM j)
SELECT locus, allele, declared, round(c0, 9) AS hap0, round(c1, 9) AS hap1, measured, CASE WHEN n = 1 THEN 'homozygous' WHEN seq IS NULL THEN 'no sequence' WHEN alike THEN 'no allelic difference' WHEN measured IS NULL THEN 'indeterminate' WHEN contains(declared, CAST(measured AS VARCHAR)) THEN 'ok' ELSE 'INVERTED' END AS status FROM m""")
def d27_phase_by_kmers(t):
    """Alleles of contigs of 512 letters, as they are or turned, against both haplotypes."""
    g = _blocks(t).groupBy("contig").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq"))), lambda x: x["seq"]), "").alias("h0"), F.count(F.lit(1)).alias("n")).where("n = 8")
    c, h0 = F.col("contig"), F.col("h0")
    s = g.select("contig", "h0", F.when(c % 5 == 0, h0).otherwise(F.concat(F.substring("h0", 1, 200), F.translate(F.substring("h0", 201, 100), "ACGT", "CATG"), F.substring("h0", 301, 212))).alias("h1"))
    second = F.when(c % 7 == 0, F.substring("h0", 400, 100)).when(c % 11 != 0, sq.reverse_complement(F.substring("h1", 150, 200)))
    on = F.when(c % 3 == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array((c % 3).cast("int")))
    a = s.select(c.alias("locus"), F.lit("a").alias("allele"), F.explode(on).alias("declared"), F.substring("h0", 150, 200).alias("seq"))
    b = s.where(c % 4 != 0).select(c.alias("locus"), F.lit("b").alias("allele"), (1 - c % 2).cast("int").alias("declared"), second.alias("seq"))
    sides = s.select(c.alias("locus"), F.explode(F.array(F.struct(F.lit(0).alias("hap"), h0.alias("seq")), F.struct(F.lit(1).alias("hap"), F.col("h1").alias("seq")))).alias("x")).select("locus", "x.hap", "x.seq")
    out = phasing.phase_by_containment(a.unionByName(b), sides, 21)
    return out.withColumn("hap0", F.round("hap0", 9)).withColumn("hap1", F.round("hap1", 9))


_DRAW = "(CAST(('0x' || substr(md5('53:' || {key}), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE >= 0.5)"


@query(f"""WITH m AS (SELECT 'c' || l_suppkey % 5 AS chrom, l_orderkey AS pos, min((l_linenumber, l_partkey % 2, l_returnflag <> 'N')) AS m FROM lineitem GROUP BY ALL),
r AS (SELECT chrom, pos, 'A' AS ref, 'T' AS alt, CASE WHEN m[1] = 7 THEN NULL WHEN m[1] % 4 = 0 THEN 1 ELSE m[2] END AS g0, CASE WHEN m[1] % 4 = 0 THEN 1 ELSE 1 - m[2] END AS g1, m[3] AS phased, pos // 50 AS ps FROM m),
panel AS (SELECT chrom, pos, pos // 3 % 2 AS h0, 1 - pos // 3 % 2 AS h1 FROM r WHERE pos // 50 % 8 = 0 AND pos % 3 = 0),
lone AS (SELECT DISTINCT r.chrom, r.pos FROM r JOIN supplier ON r.chrom = 'c0' AND r.pos >= s_suppkey * 300 AND r.pos < s_suppkey * 300 + 40),
votes AS (SELECT chrom, ps, sum((g0 <> h0)::INT) * 2 > count(*) AS flip FROM r JOIN panel USING (chrom, pos) WHERE g0 <> g1 AND phased GROUP BY ALL),
steps AS (SELECT DISTINCT chrom, ps // 4 AS grp, ps, list_reduce([0, 1, 1, 0][1:CAST(ps % 4 + 1 AS BIGINT)], lambda a, b: a + b) % 2 = 1 AS off FROM (SELECT chrom, unnest(range(0, (SELECT max(pos) // 50 FROM r) + 2)) AS ps FROM (SELECT DISTINCT chrom FROM r))),
lead_ AS (SELECT s.chrom, s.ps, s.off, s.grp, v.flip AS own, h.flip AS head FROM steps s LEFT JOIN votes v ON v.chrom = s.chrom AND v.ps = s.ps LEFT JOIN votes h ON h.chrom = s.chrom AND h.ps = s.grp * 4),
b AS (SELECT chrom, ps, CASE WHEN own IS NOT NULL THEN 'block' WHEN head IS NOT NULL THEN 'linked' ELSE 'component' END AS kind, CASE WHEN own IS NOT NULL THEN own WHEN head IS NOT NULL THEN head <> off ELSE off <> {_DRAW.format(key="chrom || ':' || grp * 4")} END AS turn FROM lead_),
j AS (SELECT r.*, p.h0, p.h1, lone.pos IS NOT NULL AS one, kind, turn, {_DRAW.format(key="r.chrom || ':' || r.pos || ':A:T'")} AS draw FROM r LEFT JOIN panel p ON p.chrom = r.chrom AND p.pos = r.pos LEFT JOIN lone ON lone.chrom = r.chrom AND lone.pos = r.pos LEFT JOIN b ON b.chrom = r.chrom AND b.ps = r.ps),
k AS (SELECT *, CASE WHEN g0 IS NULL OR g1 IS NULL THEN NULL WHEN one THEN 'haploid' WHEN g0 = g1 THEN 'hom' WHEN h0 IS NOT NULL THEN 'panel' WHEN phased THEN kind ELSE 'random' END AS source FROM j)
SELECT chrom, pos, ref, alt, CAST(CASE WHEN source = 'haploid' THEN least(g0, g1) WHEN source = 'panel' THEN h0 WHEN source IN ('block', 'linked', 'component') AND turn OR source = 'random' AND draw THEN g1 ELSE g0 END AS BIGINT) AS gt0,
CAST(CASE WHEN source = 'haploid' THEN NULL WHEN source = 'panel' THEN h1 WHEN source IN ('block', 'linked', 'component') AND turn OR source = 'random' AND draw THEN g0 ELSE g1 END AS BIGINT) AS gt1, source FROM k""")
def d29_phase_by_links(t):
    """Blocks of 50 places, linked in fours; the panel covers every other four's first block."""
    m = t.lineitem.groupBy(F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), F.col("l_orderkey").alias("pos")).agg(F.min(F.struct("l_linenumber", (F.col("l_partkey") % 2).alias("side"), (F.col("l_returnflag") != "N").alias("phased"))).alias("m"))
    hom = F.col("m.l_linenumber") % 4 == 0
    r = m.select("chrom", "pos", F.lit("A").alias("ref"), F.lit("T").alias("alt"), F.when(F.col("m.l_linenumber") != 7, F.when(hom, 1).otherwise(F.col("m.side"))).alias("gt0"), F.when(hom, 1).otherwise(1 - F.col("m.side")).alias("gt1"), F.col("m.phased").alias("phased"), F.floor(F.col("pos") / 50).alias("ps"))
    h0 = F.floor(F.col("pos") / 3) % 2
    panel = r.where("ps % 8 = 0 and pos % 3 = 0").select("chrom", "pos", "ref", "alt", h0.alias("h0"), (1 - h0).alias("h1"))
    last = r.agg(F.floor(F.max("pos") / 50).alias("top"))
    chain = r.groupBy("chrom").agg((F.floor(F.max("pos") / 50) * 0).alias("z")).withColumn("one", F.lit(1)).join(last.withColumn("one", F.lit(1)), "one").select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.col("top"))).alias("a")).where("a % 4 < 3")
    links = chain.select("chrom", "a", (F.col("a") + 1).alias("b"), (F.col("a") % 4 < 2).alias("opposite"))
    haploid = t.supplier.select(F.lit("c0").alias("chrom"), (F.col("s_suppkey") * 300).alias("start"), (F.col("s_suppkey") * 300 + 40).alias("end"))
    return phasing.combined_phase(r, panel, links, haploid, 53)


# 96 channels by rule: 32 contexts with C or T in the middle, three changes each, weights 1 to 7.
_CHANNELS = [(f"{a}[{b}>{x}]{c}", f"{a}{b}{c}", b, x, 1 + (ord(a) + 2 * ord(b) + 3 * ord(c) + 5 * ord(x)) % 7) for a in "ACGT" for b in "CT" for c in "ACGT" for x in "ACGT" if x != b]
_CH = "(VALUES " + ", ".join(f"('{n}', '{c}', '{r}', '{x}', {w})" for n, c, r, x, w in _CHANNELS) + ") v(channel, context, ref, alt, w)"
_CODE = "CAST('0x' || substr(md5('61:' || contig || ':' || context), 1, 12) AS BIGINT)"


@query(f"""WITH {_CONTIGS},
kept AS (SELECT l.contig, l.spot, CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.contig = l.contig AND p_size % 5 = 0 AND l.spot >= block * 64 + 10 AND l.spot < block * 64 + 80) THEN 'N' ELSE letter END AS letter FROM letters l),
tri AS (SELECT contig, spot, letter, coalesce(lag(letter) OVER w, 'N') || letter || coalesce(lead(letter) OVER w, 'N') AS three, lag(spot) OVER w AS a, lead(spot) OVER w AS z FROM kept WINDOW w AS (PARTITION BY contig ORDER BY spot)),
ctx AS (SELECT contig, spot, three, CASE WHEN letter IN ('A', 'G') THEN reverse(translate(three, 'ACGT', 'TGCA')) ELSE three END AS context FROM tri WHERE a = spot - 1 AND z = spot + 1 AND NOT contains(three, 'N')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY contig, context ORDER BY spot) - 1 AS rank, count(*) OVER (PARTITION BY contig, context) AS places FROM ctx),
want AS (SELECT contig, CAST(round(count(*) FILTER (letter <> 'N') * 30000.0::DOUBLE / 1e6) AS BIGINT) AS n FROM kept GROUP BY 1),
ex AS (SELECT contig, v.*, n, n * w / (SELECT sum(w) FROM {_CH})::DOUBLE AS exact FROM want, {_CH}),
ap AS (SELECT *, CAST(floor(exact) AS BIGINT) + CASE WHEN row_number() OVER (PARTITION BY contig ORDER BY exact - floor(exact) DESC, channel) <= n - sum(CAST(floor(exact) AS BIGINT)) OVER (PARTITION BY contig) THEN 1 ELSE 0 END AS m FROM ex),
cum AS (SELECT *, sum(m) OVER (PARTITION BY contig, context ORDER BY channel) AS upto FROM ap),
draws AS (SELECT contig, context, channel, ref, alt, unnest(range(CAST(upto - m AS BIGINT), CAST(upto AS BIGINT))) AS j FROM cum),
sized AS (SELECT d.*, places, {_CODE} AS code FROM draws d JOIN (SELECT DISTINCT contig, context, places FROM ranked) p USING (contig, context) WHERE j < places),
at_ AS (SELECT *, (code % places + j * ([2147483647, 2147483629, 2147483587, 2147483579][CAST(code % 4 + 1 AS BIGINT)] % places)) % places AS rank FROM sized),
put AS (SELECT r.contig, spot + 1 AS pos, substr(three, 2, 1) IN ('A', 'G') AS turned, ref, alt, three, channel FROM at_ a JOIN ranked r USING (contig, context, rank))
SELECT contig, pos, CASE WHEN turned THEN translate(ref, 'ACGT', 'TGCA') ELSE ref END AS ref, CASE WHEN turned THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END AS alt, three AS context, channel,
CASE WHEN u < 0.15 THEN 'a' WHEN u < 0.4 THEN 'b' ELSE 'trunk' END AS clone FROM (SELECT *, {_U.format(seed=61, key="contig || ':' || pos")} AS u FROM put)""")
def d11_channel_background(t):
    """Changes by 96 channels outside of reserved spans; the trunk has 0.6 of them."""
    channels = t.spark.createDataFrame([(n, c, r, x, float(w)) for n, c, r, x, w in _CHANNELS], "channel string, context string, ref string, alt string, weight double")
    clones = t.spark.createDataFrame([("a", 0.15), ("b", 0.25), ("trunk", 0.6)], "clone string, share double")
    k = _dna(t).where("p_size % 5 = 0").select(F.floor(F.col("p_partkey") / 8).alias("contig"), (F.col("p_partkey") % 8 * 64 + 10).alias("start"), (F.col("p_partkey") % 8 * 64 + 80).alias("end"))
    return passengers.background(_blocks(t), channels, clones, 30000.0, 61, 64, k)


@query("""WITH c AS (SELECT kind, props, CASE WHEN json_valid(props) THEN props END AS doc FROM clicks),
s AS (SELECT kind, props, TRY_CAST(json_extract_string(doc, '$.items[0].qty') AS BIGINT) AS qty, TRY_CAST(json_extract_string(doc, '$.k') AS BIGINT) AS k, json_extract_string(doc, '$.device.os') AS os, doc IS NOT NULL AS ok FROM c)
SELECT coalesce(kind, 'none') AS kind, count(*) AS sidecars, count(*) FILTER (coalesce(ok, false)) AS read_, CAST(sum(CASE WHEN ok THEN coalesce(qty, k, 0) ELSE 0 END) AS BIGINT) AS measured, count(DISTINCT CASE WHEN ok THEN os END) AS systems, CAST(sum(octet_length(encode(coalesce(props, ''))) + 1) AS BIGINT) AS bytes FROM s GROUP BY 1""")
def d41_sidecars_of_versions(t):
    """Sidecars of several versions, as files by kind: the newest key that one has, and the files' bytes."""
    path = folders.scratch(t.spark, "sidecars")
    t.clicks.select(F.coalesce("props", F.lit("")).alias("value"), F.coalesce("kind", F.lit("none")).alias("kind")).write.partitionBy("kind").text(path)
    return readers.sidecar_totals(t.spark, path, "kind", {"measured": ["$.items[0].qty", "$.k"]}, {"systems": "$.device.os"})


@query("SELECT 'c' || p_partkey % 3 AS contig, p_partkey AS pos, p_size AS depth, upper(replace(p_name, ' ', '.')) || 'AC' AS bases FROM part WHERE p_size > 5")
def s19_pileup_bases(t):
    """Bases with read starts, ends, an insertion of twelve letters and a deletion of one; short lines among them."""
    noisy = F.concat(F.lit("^]"), F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("+12acgtacgtacgta$-1cC"))
    line = F.concat_ws("\t", F.concat(F.lit("c"), (F.col("p_partkey") % 3).cast("string")), "p_partkey", F.lit("N"), "p_size", F.when(F.col("p_size") > 5, noisy))
    return readers.pileup(t.part.select(line.alias("value")))


@query(f"""WITH {_P}, b AS (SELECT p_partkey, p_size, CASE WHEN p_size % 2 = 0 THEN 'far' ELSE 'near' END AS target, p_size % 7 + 1 AS skip FROM p)
SELECT p_partkey, target, spot, ref, alt FROM (SELECT p_partkey, target, 100 + skip AS spot, 'A' AS ref, 'G' AS alt FROM b UNION ALL SELECT p_partkey, target, 100 + skip + 1 + 5, 'ACG', '' FROM b UNION ALL SELECT p_partkey, target, 100 + skip + 1 + 5 + 3 + 2, '', 'TT' FROM b)""")
def s19_alignment_edits(t):
    """Each part's alignment with the most matches, and the edits that its difference text tells."""
    k, size = F.col("p_partkey").cast("string"), F.col("p_size")
    cs = F.concat(F.lit("cs:Z::"), (size % 7 + 1).cast("string"), F.lit("*ag:5-acg:2+tt:9"))

    def line(target, matches, *tags):
        return F.concat_ws("\t", k, F.lit("60"), F.lit("0"), F.lit("50"), F.lit("+"), F.lit(target), F.lit("900"), F.lit("100"), F.lit("150"), matches.cast("string"), F.lit("60"), F.lit("60"), F.lit("NM:i:3"), *tags)

    lines = dealt(t.part.select("p_partkey", "p_size")).select(F.explode(F.array(line("far", F.when(size % 2 == 0, 48).otherwise(30), cs), line("near", F.lit(40), cs), line("other", F.lit(10)), F.lit("cut\t60"))).alias("value"))
    best = readers.best_alignments(readers.pairwise_alignments(lines))
    d = best.select(F.col("query").cast("long").alias("p_partkey"), "target", F.explode(sq.difference_edits(F.col("cs"), F.col("target_start"))).alias("e"))
    return d.select("p_partkey", "target", F.col("e.start").alias("spot"), "e.ref", "e.alt")


_SAMPLES = [
    ("exome_tumor", "WES", False, False, "{d}_tumor_wes", "{d}_part_tumor_wes", "Illumina"), ("exome_normal", "WES", True, False, "{d}_normal_wes", "{d}_part_normal_wes", "Illumina"),
    ("rna_tumor", "RNA-Seq", False, True, "{d}_full_rna", "{d}_part_rna", "Illumina"), ("cells_tumor", "scRNA-Seq", False, True, "{d}-CELLS_S1", "{d}-part-CELLS_S1", "Illumina"),
    ("long_tumor", "WGS", False, False, "{d}_tumor_long", "{d}_part_tumor_long", "PacBio"), ("long_normal", "WGS", True, False, "{d}_normal_long", "{d}_part_normal_long", "PacBio"),
]
_SAMPLES_SQL = "(VALUES " + ", ".join(f"('{a}', '{m}', {n}, {r}, '{f}', '{p}', '{x}')" for a, m, n, r, f, p, x in _SAMPLES) + ") v(label, method, normal, rna, full_, subset, platform)"


@query(f"""WITH d AS (SELECT n_name AS dataset, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) AS alleles, CAST(n_nationkey AS VARCHAR) AS grp FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_suppkey <= 200 GROUP BY n_name, n_nationkey),
m AS (SELECT *, CASE WHEN release = 'full' THEN full_ ELSE subset END AS tmpl FROM d, {_SAMPLES_SQL}, (VALUES ('full'), ('part')) r(release))
SELECT dataset AS patient, CASE WHEN release = 'full' THEN dataset ELSE dataset || '-' || release END AS dataset, CASE WHEN normal THEN 'n' ELSE 'a' END || CASE WHEN rna THEN 'r' ELSE 'd' END || '-' || replace(label, '_', '-') AS run_name,
dataset || substr(tmpl, 4, 1) || '20240131' || substr(tmpl, 4) AS file_prefix, method, normal, grp AS "group", alleles, platform, CASE platform WHEN 'Illumina' THEN 'short-read' ELSE 'long-read' END AS read_type, CASE WHEN normal THEN 'blood-normal' ELSE 'tumor' END AS sample_type FROM m""")
def d34_guarded_manifest(t):
    """Nations as data sets in two releases, of a version; no prefix begins another, nor one without a version."""
    s = t.supplier.where("s_suppkey <= 200").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda x: x.cast("string")), ",")  # at most 200 of them
    datasets = s.groupBy(F.col("n_name").alias("dataset"), F.col("n_nationkey").cast("string").alias("group")).agg(names.alias("alleles"))
    samples = t.spark.createDataFrame(_SAMPLES, "label string, method string, normal boolean, rna boolean, full string, subset string, platform string")
    made = [bundles.manifest(datasets, samples, ("full", "part"), v) for v in ("20240131", "")]
    return bundles.guarded(*made)


@query(f"""WITH {_CONTIGS}, {_CODONS}, g AS (SELECT contig, string_agg(dna, '' ORDER BY block) AS seq FROM k GROUP BY 1 HAVING count(*) = 8),
cd AS (SELECT contig, CASE WHEN contig % 2 = 1 THEN reverse(translate(x, 'ACGT', 'TGCA')) ELSE x END AS cds, list_concat(list_concat(range(10, 100), range(130, 250)), range(300, 400)) AS up FROM (SELECT contig, substr(seq, 11, 90) || substr(seq, 131, 120) || substr(seq, 301, 100) AS x FROM g)),
pl AS (SELECT contig, cds, CASE WHEN contig % 2 = 1 THEN list_reverse(up) ELSE up END AS places FROM cd),
s AS (SELECT c_custkey AS event, 1 + c_custkey % 30 AS contig, c_custkey % 316 + 1 AS first_, c_custkey % 316 + 1 + c_custkey % 4 AS last_, c_custkey % 3 AS h, c_custkey % 5 AS l FROM customer),
j AS (SELECT s.*, cds, places, (first_ - 1) // 3 + 1 AS codon, (first_ - 1) // 3 + 1 + CASE WHEN event % 7 = 0 THEN 1 ELSE 0 END AS want, CASE h WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE CASE l WHEN 0 THEN 0 WHEN 1 THEN 1 END END AS hap FROM s LEFT JOIN pl USING (contig)),
a AS (SELECT j.*, aa AS wt_aa FROM j LEFT JOIN codons ON codons.codon = substr(cds, CAST((j.codon - 1) * 3 + 1 AS BIGINT), 3)),
q AS (SELECT *, list_max(places[CAST(first_ AS BIGINT):CAST(last_ AS BIGINT)]) - list_min(places[CAST(first_ AS BIGINT):CAST(last_ AS BIGINT)]) <> last_ - first_ AS split FROM a)
SELECT event, CAST(codon AS BIGINT) AS codon, wt_aa, CAST(hap AS INTEGER) AS haplotype, concat_ws(',', CASE WHEN cds IS NULL THEN 'no transcript' END, CASE WHEN last_ > length(cds) THEN 'past the coding sequence' END, CASE WHEN last_ <= length(cds) AND split THEN 'spans an intron' END, CASE WHEN codon <> want THEN 'other codon' END, CASE WHEN hap IS NULL THEN 'no single haplotype' END) AS problems FROM q""")
def d30_spike_in_resolution(t):
    """Deletions by coding places of contigs' three exons, on either strand, held against what is expected."""
    exons = F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((10, 100), (130, 250), (300, 400))])
    genes = _blocks(t).groupBy("contig").agg(F.count(F.lit(1)).alias("n")).where("n = 8").select(F.col("contig").alias("gene"), "contig", F.when(F.col("contig") % 2 == 1, "-").otherwise("+").alias("strand"), exons.alias("exons"))
    k = F.col("c_custkey")
    first = k % 316 + 1
    codon = F.floor((first - 1) / 3) + 1 + F.when(k % 7 == 0, 1).otherwise(0)
    specs = dealt(t.customer.select("c_custkey")).select(k.alias("event"), (1 + k % 30).alias("gene"), first.alias("first"), (first + k % 4).alias("last"), F.when(k % 3 == 2, "retained").otherwise((k % 3).cast("string")).alias("haplotype"), (k % 5).alias("label"), codon.alias("expect_codon"), F.lit(None).cast("string").alias("expect_aa"), F.lit(None).cast("string").alias("expect_effect"))
    losses = t.region.select(F.col("r_regionkey").alias("label"), F.when(F.col("r_regionkey") == 1, 0).when(F.col("r_regionkey") == 3, 0).otherwise(1).alias("cn0"), F.when(F.col("r_regionkey").isin(0, 3), 0).otherwise(2).alias("cn1"))
    nothing = _blocks(t).select("contig", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")).where("false")
    return spikeins.resolve(specs, genes, _blocks(t), 64, nothing, losses).select("event", "codon", "wt_aa", "haplotype", "problems")
