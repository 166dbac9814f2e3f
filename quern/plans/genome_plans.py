"""Composite queries over places: context, epitopes, fusion junctions, uniform slices.

Eight parts of 64 letters in a row make a contig of 512."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import genome, intervals, sampling
from ..sources.folders import written
from ._dealt import dealt
from .registry import query
from .scalar_plans import _P, _dna

_U = "(CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE)"
_NEAR = "substr(w, greatest(c - 12, 0) + 1, c - greatest(c - 12, 0) + 13)"


def _run_sql(i: str) -> str:
    """The run of one letter through place i of z, 1 outside of it."""
    left, right = f"substr(z, 1, {i} + 1)", f"substr(z, {i} + 1)"
    letter = f"substr(z, {i} + 1, 1)"
    return f"CASE WHEN {i} >= 0 AND {i} < length(z) THEN length({left}) - length(rtrim({left}, {letter})) + length({right}) - length(ltrim({right}, {letter})) - 1 ELSE 1 END"


@query(f"""WITH {_P}, k AS (SELECT *, p_partkey // 8 AS contig, p_partkey % 8 * 64 AS base FROM p), g AS (SELECT contig, string_agg(dna, '' ORDER BY base) AS seq FROM k GROUP BY 1),
s AS (SELECT DISTINCT l_partkey // 8 AS contig, l_partkey % 8 * 64 + l_suppkey % 64 AS pos FROM lineitem),
het AS (SELECT DISTINCT contig, base + p_size AS pos FROM k WHERE p_size % 3 = 0), cap AS (SELECT contig, base + p_size AS a, base + p_size + 40 AS b FROM k WHERE p_size % 2 = 0),
rep AS (SELECT contig, base AS a, base + 20 + p_size % 10 AS b, p_brand AS name FROM k WHERE p_partkey % 3 = 0), dup AS (SELECT contig, base + 10 AS a, base + 90 AS b FROM k WHERE p_size % 7 = 0), cds AS (SELECT contig, base + 5 AS a, base + 50 AS b FROM k WHERE p_size % 4 = 1),
t AS (SELECT s.contig, s.pos, substr(seq, CAST(greatest(pos - 50, 0) AS BIGINT) + 1, CAST(pos + 50 - greatest(pos - 50, 0) AS BIGINT)) AS w, CAST(pos - greatest(pos - 50, 0) AS BIGINT) AS c FROM s JOIN g USING (contig)),
r AS (SELECT contig, pos, w, {_NEAR} AS z, c - greatest(c - 12, 0) AS i FROM t),
h AS (SELECT s.contig, s.pos, count(*) AS n, min(abs(het.pos - s.pos)) AS d FROM s JOIN het ON het.contig = s.contig AND het.pos <> s.pos AND abs(het.pos - s.pos) <= 30 GROUP BY ALL),
e AS (SELECT s.contig, s.pos, min(least(s.pos - a, b - 1 - s.pos)) AS d FROM s JOIN cap ON cap.contig = s.contig AND s.pos >= a AND s.pos < b GROUP BY ALL),
q AS (SELECT s.contig, s.pos, arg_min(name, (a, b, name)) AS name FROM s JOIN rep ON rep.contig = s.contig AND s.pos >= a AND s.pos < b GROUP BY ALL),
u AS (SELECT DISTINCT s.contig, s.pos, true AS yes FROM s JOIN dup ON dup.contig = s.contig AND s.pos >= a AND s.pos < b),
v AS (SELECT s.contig, s.pos, min(least(s.pos - a, b - 1 - s.pos)) AS d FROM s JOIN cds ON cds.contig = s.contig AND s.pos >= a AND s.pos < b GROUP BY ALL)
SELECT contig, pos, greatest({_run_sql("(i - 1)")}, {_run_sql("i")}, {_run_sql("(i + 1)")}) AS homopolymer_run, coalesce(h.n, 0) AS hets_near, h.d AS nearest_het, e.d AS capture_edge, e.d IS NOT NULL AS on_target, q.name AS repeat, coalesce(yes, false) AS segdup, v.d AS cds_edge, round(length(regexp_replace(w, '[^GC]', '', 'g')) / length(w)::DOUBLE, 3) AS gc
FROM s LEFT JOIN r USING (contig, pos) LEFT JOIN h USING (contig, pos) LEFT JOIN e USING (contig, pos) LEFT JOIN q USING (contig, pos) LEFT JOIN u USING (contig, pos) LEFT JOIN v USING (contig, pos)""")
def d37_context_features(t):
    contig, base = F.floor(F.col("p_partkey") / 8), F.col("p_partkey") % 8 * 64
    k = _dna(t).select("*", contig.alias("contig"), base.alias("base"))
    span = lambda d, a, b: d.select("contig", a.cast("long").alias("start"), b.cast("long").alias("end"), F.col("p_brand").alias("name"))
    base, size = F.col("base"), F.col("p_size")
    return genome.context_features(
        t.lineitem.select(F.floor(F.col("l_partkey") / 8).alias("contig"), (F.col("l_partkey") % 8 * 64 + F.col("l_suppkey") % 64).alias("pos")),
        k.select("contig", (F.col("p_partkey") % 8).alias("block"), F.col("dna").alias("seq")), 64,
        hets=k.where("p_size % 3 = 0").select("contig", (base + size).alias("pos")),
        capture=span(k.where("p_size % 2 = 0"), base + size, base + size + 40),
        repeats=span(k.where("p_partkey % 3 = 0"), base, base + 20 + size % 10),
        segdups=span(k.where("p_size % 7 = 0"), base + 10, base + 90),
        coding=span(k.where("p_size % 4 = 1"), base + 5, base + 50))


def _score(pep, allele):
    """A stand-in for a predictor: rank and affinity from a hash of peptide and allele."""
    return F.round(sampling.uniform(21, pep, allele) * 20, 6), F.round(1 + sampling.uniform(22, pep, allele) * 50000, 3)


def _score_sql(pep, allele):
    key = f"{pep} || ':' || {allele}"
    return f"round({_U.format(seed=21, key=key)} * 20, 6) AS rank, round(1 + {_U.format(seed=22, key=key)} * 50000, 3) AS affinity"


@query(f"""WITH m AS (SELECT DISTINCT p_partkey, substr(p_name, CAST(i AS BIGINT), 5) AS pep FROM part, unnest(range(1, 60)) u(i) WHERE i + 4 <= length(p_name)), w AS (SELECT DISTINCT upper(substr(p_type, CAST(i AS BIGINT), 5)) AS pep FROM part, unnest(range(1, 60)) u(i) WHERE i + 4 <= length(p_type)),
n AS (SELECT m.p_partkey, m.pep, ['A', 'B', 'C', '-'][p_size % 4 + 1] AS lost FROM m JOIN part USING (p_partkey) WHERE upper(m.pep) NOT IN (SELECT pep FROM w)),
s AS (SELECT p_partkey, pep, a AS allele, a <> lost AS kept, {_score_sql("pep", "a")} FROM n, (VALUES ('A'), ('B'), ('C')) v(a)),
e AS (SELECT p_partkey, count(*) FILTER (r <= 2) AS n_low FROM (SELECT p_partkey, pep, min(rank) AS r FROM s GROUP BY ALL) GROUP BY ALL),
x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY rank, pep, allele) AS rn FROM s) WHERE rn = 1),
y AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY rank, pep, allele) AS rn FROM s WHERE kept) WHERE rn = 1),
z AS (SELECT p.p_partkey, ['A', 'B', 'C', '-'][p.p_size % 4 + 1] AS lost, x.rank AS xr, x.allele AS xa, x.affinity AS xf, x.pep AS xp, n_low, y.rank AS yr, y.allele AS ya, y.pep AS yp, CASE WHEN instr(p_name, x.pep) + 4 <= length(p_type) AND substr(p_type, instr(p_name, x.pep), 5) <> x.pep THEN substr(p_type, instr(p_name, x.pep), 5) END AS wt FROM part p LEFT JOIN x USING (p_partkey) LEFT JOIN y USING (p_partkey) LEFT JOIN e USING (p_partkey)),
o AS (SELECT *, {_score_sql("wt", "xa")} FROM z)
SELECT p_partkey, xr AS best_rank, xa AS best_allele, xf AS best_affinity, xp AS best_peptide, CASE WHEN xr IS NULL THEN 'na' WHEN xr <= 0.5 THEN 'strong' WHEN xr <= 2 THEN 'weak' ELSE 'non' END AS tier, coalesce(n_low, 0) AS n_low, yr AS retained_rank, ya AS retained_allele, yp AS retained_peptide, CASE WHEN yr IS NULL THEN 'na' WHEN yr <= 0.5 THEN 'strong' WHEN yr <= 2 THEN 'weak' ELSE 'non' END AS retained_tier, coalesce(xa = lost, false) AS best_is_lost, wt AS wt_peptide, CASE WHEN wt IS NOT NULL THEN rank END AS wt_rank, CASE WHEN wt IS NOT NULL THEN round(affinity / xf, 6) END AS agretopicity FROM o""")
def d7_neoepitopes(t):
    own = t.part.select(F.col("p_partkey").alias("key"), F.explode(sq.kmers(F.col("p_name"), 5, "\0")).alias("pep"))
    wild = t.part.select(F.explode(sq.kmers(F.col("p_type"), 5, "\0")).alias("w")).select(F.upper("w").alias("w")).distinct()
    new = own.join(wild, F.upper("pep") == F.col("w"), "left_anti")
    lost = F.element_at(F.array(*[F.array(F.lit(a)) for a in "ABC-"]), (F.col("p_size") % 4 + 1).cast("int"))
    c = t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("mutant"), F.col("p_type").alias("wild"), lost.alias("lost"))
    return genome.epitopes(c, new, "ABC", _score).withColumn("agretopicity", F.round("agretopicity", 6)).withColumnRenamed("key", "p_partkey")


_SEGMENTS = f"WITH {_P}, x AS (SELECT l_orderkey, list(substr(dna, 1, CAST(l_quantity AS BIGINT)) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS segs FROM lineitem JOIN p ON p_partkey = l_partkey GROUP BY 1), o AS (SELECT o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS partner FROM orders)"


@query(_SEGMENTS + f""", q AS (SELECT o_orderkey, partner, l.segs AS l, r.segs AS r FROM o JOIN x l ON l.l_orderkey = o_orderkey JOIN x r ON r.l_orderkey = partner),
c AS (SELECT o_orderkey, partner, i, j, len(l) AS n5, len(r) AS n3, length(array_to_string(l[1:i], '')) AS head, array_to_string(l[1:i], '') || array_to_string(r[j + 1:], '') AS cds FROM (SELECT *, unnest(range(1, len(l))) AS i FROM q), unnest(range(1, len(r))) u(j)),
s AS (SELECT *, head // 3 AS codon, length(cds) // 3 AS codons, coalesce(list_position(list_transform(range(0, length(cds) // 3), lambda k: substr(cds, k * 3 + 1, 3) IN ('TAA', 'TAG', 'TGA')), true), 0) AS stop FROM c WHERE head % 3 = 0),
f AS (SELECT *, CASE WHEN stop > 0 THEN stop - 1 ELSE codons END AS protein_len FROM s WHERE stop = 0 OR stop > codon),
k AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, partner ORDER BY abs(i / n5 - 0.5) + abs(j / n3 - 0.5), i, j) AS rn, count(*) OVER (PARTITION BY o_orderkey, partner) AS options FROM f WHERE protein_len >= 12)
SELECT o_orderkey, partner, CAST(options AS INTEGER) AS options, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, protein_len FROM k WHERE rn = CASE WHEN options < 4 THEN 1 ELSE 1 + floor({_U.format(seed=34, key="o_orderkey || ':' || partner")} * 4) END""")
def d13_junction_search(t):
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.substring(F.col("dna"), F.lit(1), F.col("l_quantity").cast("int")).alias("s"))
    segs = t.lineitem.join(_dna(t).select("p_partkey", "dna").hint("merge"), F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("segs"))
    o = t.orders.select("o_orderkey", F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("partner")).where("partner is not null")
    left, right = segs.select(F.col("l_orderkey").alias("o_orderkey"), F.col("segs").alias("left")), segs.select(F.col("l_orderkey").alias("partner"), F.col("segs").alias("right"))
    return genome.junctions(o.join(left, "o_orderkey").join(right, "partner"), ["o_orderkey", "partner"], True, 12, 34)


@query("""WITH x AS (SELECT o_custkey, o_orderkey, o_orderstatus AS contig, o_orderkey % 40 + 1 AS n, o_orderkey * 37 % 3000 + 1 AS r_start, o_orderkey % 3 = 0 AS turned, o_orderkey % 7 = 0 AS ins FROM orders),
pc AS (SELECT *, r_start + n - 1 AS r_end, CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - n + 1 AS BIGINT) AS d_start FROM x),
cut AS (SELECT DISTINCT ['F', 'O', 'P'][s_suppkey % 3 + 1] AS contig, s_suppkey * 31 % 3000 AS pos FROM supplier),
mk AS (SELECT pc.*, r_start AS a FROM pc WHERE NOT ins UNION ALL SELECT pc.*, pos FROM pc JOIN cut ON cut.contig = pc.contig AND pos > r_start AND pos <= r_end WHERE NOT ins),
sp AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY o_orderkey ORDER BY a) - 1, r_end) AS b FROM mk),
pt AS (SELECT o_custkey, contig, d_start + CASE WHEN turned THEN r_end - b ELSE a - r_start END AS s, d_start + CASE WHEN turned THEN r_end - a ELSE b - r_start END AS e, (a + b) // 2 AS spot, false AS ins FROM sp UNION ALL SELECT o_custkey, contig, d_start, d_start + n - 1, r_start, true FROM pc WHERE ins),
f AS (SELECT *, row_number() OVER w = 1 AS fst FROM pt WINDOW w AS (PARTITION BY o_custkey ORDER BY s, e)),
g AS (SELECT *, last_value(CASE WHEN fst OR NOT ins THEN contig END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM f),
h AS (SELECT *, sum((fst OR (NOT ins AND (e - s + 1 >= 8 OR prev <> contig)))::INT) OVER (PARTITION BY o_custkey ORDER BY s, e) AS k FROM g),
sl AS (SELECT o_custkey, k, arg_min(contig, s) AS contig, arg_min(spot, s) AS spot, min(s) AS s, max(e) AS e FROM h GROUP BY ALL),
bd AS (SELECT sl.*, (SELECT max(pos) FROM cut WHERE cut.contig = sl.contig AND pos <= sl.spot) AS band FROM sl),
fr AS (SELECT *, CASE WHEN lag(e) OVER w = s - 1 AND lag(contig) OVER w = contig AND lag(band) OVER w IS NOT DISTINCT FROM band THEN 0 ELSE 1 END AS fresh FROM bd WINDOW w AS (PARTITION BY o_custkey ORDER BY s)),
rn AS (SELECT *, sum(fresh) OVER (PARTITION BY o_custkey ORDER BY s) AS run FROM fr)
SELECT o_custkey, contig, band, min(s) AS start, max(e) AS "end", count(*) AS n FROM rn GROUP BY o_custkey, contig, band, run""")
def d16_uniform_slices(t):
    k = F.col("o_orderkey")
    x = t.orders.select("o_custkey", k.alias("ordinal"), F.col("o_orderstatus").alias("contig"), (k % 40 + 1).alias("n"), (k * 37 % 3000 + 1).alias("r_start"), F.when(k % 3 == 0, "-").otherwise("+").alias("strand"), (k % 7 == 0).alias("inserted"))
    upto = F.sum("n").over(Window.partitionBy("o_custkey").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0))
    pieces = x.withColumn("d_end", upto).withColumn("d_start", F.col("d_end") - F.col("n") + 1).withColumn("r_end", F.col("r_start") + F.col("n") - 1)
    s = F.col("s_suppkey")
    cuts = t.supplier.select(F.element_at(F.array(*[F.lit(c) for c in "FOP"]), (s % 3 + 1).cast("int")).alias("contig"), (s * 31 % 3000).alias("pos"))
    return genome.uniform_slices(pieces, cuts, ["o_custkey"], 8)


_DERIVED = """WITH RECURSIVE ln AS (SELECT c_custkey AS c, 2000 AS length FROM customer),
ev AS (SELECT o_custkey AS c, o_orderkey AS k, ['DEL', 'DUP', 'INV', 'INS'][o_orderkey // 5 % 4 + 1] AS kind, least(o_orderkey * 37 % 2000 + 1, o_orderkey * 37 % 2000 + o_orderkey % 60 - 4) AS s, greatest(o_orderkey * 37 % 2000 + 1, o_orderkey * 37 % 2000 + o_orderkey % 60 - 4) AS e, 20 + o_orderkey % 30 AS ins FROM orders WHERE o_custkey IN (SELECT c FROM ln)),
rk AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY s, e, k) AS rn FROM ev WHERE s >= 20 AND e <= 1980),
gr AS (SELECT c, k, kind, s, e, ins, rn, true AS kept, e AS last FROM rk WHERE rn = 1 UNION ALL SELECT rk.c, rk.k, rk.kind, rk.s, rk.e, rk.ins, rk.rn, rk.s > gr.last, CASE WHEN rk.s > gr.last THEN rk.e ELSE gr.last END FROM gr JOIN rk ON rk.c = gr.c AND rk.rn = gr.rn + 1),
kp AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY c ORDER BY s), 0) AS prev FROM gr WHERE kept),
pl AS (SELECT c, s AS o, 0 AS step, prev + 1 AS rs, s - 1 AS re, '+' AS strand, 'ref' AS kind, NULL::VARCHAR AS event, 0 AS ins FROM kp WHERE prev + 1 <= s - 1
 UNION ALL SELECT c, s, 1, s, e, CASE kind WHEN 'INV' THEN '-' ELSE '+' END, CASE kind WHEN 'INV' THEN 'inv' ELSE 'ref' END, CAST(k AS VARCHAR), 0 FROM kp WHERE kind <> 'DEL'
 UNION ALL SELECT c, s, 2, s, CASE kind WHEN 'INS' THEN s ELSE e END, '+', CASE kind WHEN 'INS' THEN 'insert' ELSE 'dup' END, CAST(k AS VARCHAR), CASE kind WHEN 'INS' THEN ins ELSE 0 END FROM kp WHERE kind IN ('DUP', 'INS')
 UNION ALL SELECT ln.c, 2001, 0, coalesce(max(e), 0) + 1, 2000, '+', 'ref', NULL, 0 FROM ln LEFT JOIN kp ON kp.c = ln.c GROUP BY ln.c),
mv AS (SELECT CAST(o_orderkey AS VARCHAR) || 't' AS move, o_custkey AS a, o_orderkey * 53 % 2000 + 1 AS pa, o_custkey + 1 AS b, o_orderkey * 29 % 2000 + 1 AS pb FROM orders WHERE o_orderkey % 17 = 0),
en AS (SELECT move, a AS c, pa AS cut, b AS partner, pb + 1 AS since FROM mv UNION ALL SELECT move, b, pb, a, pa + 1 FROM mv),
ct AS (SELECT c, count(*) AS n FROM en GROUP BY 1),
sg AS (SELECT en.*, x.n, y.n AS m, z.c IS NOT NULL AS there FROM en JOIN ct x ON x.c = en.c JOIN ct y ON y.c = en.partner LEFT JOIN ln z ON z.c = en.partner),
ab AS (SELECT pl.c, move, NOT bool_or(rs <= cut AND re > cut AND (kind <> 'ref' OR strand <> '+')) AND bool_or(rs <= cut) AND bool_and(there AND since <= 2000) AS able FROM pl JOIN sg ON sg.c = pl.c WHERE n = 1 AND m = 1 GROUP BY ALL)"""


@query(_DERIVED + """, dr AS (SELECT pl.c, o, step, pl.c AS source, rs, CASE WHEN coalesce(able, false) THEN least(re, cut) ELSE re END AS re, strand, kind, event, ins FROM pl LEFT JOIN ab ON ab.c = pl.c LEFT JOIN sg ON sg.c = pl.c AND sg.move = ab.move WHERE NOT coalesce(able, false) OR rs <= cut
 UNION ALL SELECT sg.c, 3000, 3, partner, since, 2000, '+', 'ref', sg.move, 0 FROM ab JOIN sg ON sg.c = ab.c AND sg.move = ab.move WHERE able),
ln2 AS (SELECT *, CASE kind WHEN 'insert' THEN ins ELSE re - rs + 1 END AS n FROM dr),
sm AS (SELECT *, row_number() OVER w AS ordinal, CAST(sum(n) OVER w AS BIGINT) AS d_end FROM ln2 WINDOW w AS (PARTITION BY c ORDER BY o, step))
SELECT c AS contig, CAST(ordinal AS INTEGER) AS ordinal, d_end - n + 1 AS d_start, d_end, source, rs AS r_start, re AS r_end, strand, kind, event FROM sm""")
def d15_derived_plan(t):
    return _derived(t)[0]


@query(_DERIVED + """ SELECT CAST(k AS VARCHAR) AS event, c AS contig, CASE WHEN s < 20 OR e > 1980 THEN 'outside' END AS status FROM ev WHERE s < 20 OR e > 1980 UNION ALL SELECT CAST(k AS VARCHAR), c, CASE WHEN kept THEN 'applied' ELSE 'dropped' END FROM gr UNION ALL SELECT sg.move, sg.c, CASE WHEN n > 1 OR m > 1 THEN 'skipped' WHEN able THEN 'placed' ELSE 'not placed' END FROM sg LEFT JOIN ab ON ab.c = sg.c WHERE sg.c IN (SELECT c FROM ln)""")
def d15_derived_report(t):
    return _derived(t)[1]


def _derived(t):
    k = F.col("o_orderkey")
    lengths = t.customer.select(F.col("c_custkey").alias("contig"), F.lit(2000).cast("long").alias("length"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("DEL", "DUP", "INV", "INS")]), (F.floor(k / 5) % 4 + 1).cast("int"))
    events = t.orders.select(F.col("o_custkey").alias("contig"), k.alias("event"), kind.alias("kind"), (k * 37 % 2000 + 1).alias("start"), (k * 37 % 2000 + k % 60 - 4).alias("end"), (k % 30 + 20).alias("ins_len"))
    moves = t.orders.where("o_orderkey % 17 = 0").select(F.concat(k.cast("string"), F.lit("t")).alias("event"), F.col("o_custkey").alias("a"), (k * 53 % 2000 + 1).alias("pos_a"), (F.col("o_custkey") + 1).alias("b"), (k * 29 % 2000 + 1).alias("pos_b"))
    return genome.derived_plan(lengths, events, moves, 20)


_BAITS = """b AS (SELECT o_custkey AS c, greatest(1, o_orderkey * 613 % 60000 + 1 - 100) AS s, o_orderkey * 613 % 60000 + 200 + 100 AS e FROM orders),
f AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY c ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 200 THEN 0 ELSE 1 END AS fresh FROM b), g AS (SELECT *, sum(fresh) OVER (PARTITION BY c ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM f), m AS (SELECT c, min(s) AS s, max(e) AS e FROM g GROUP BY c, k)"""


@query(f"""WITH {_BAITS}, n AS (SELECT *, lag(e) OVER w AS p, lead(s) OVER w AS q FROM m WINDOW w AS (PARTITION BY c ORDER BY s, e)),
o AS (SELECT c, band, depth, greatest(coalesce(p, 0) + 1, s - hi) AS s, s - lo AS e FROM n, (VALUES ('proximal', 1, 500, 0.15::DOUBLE), ('mid', 501, 2000, 0.02::DOUBLE)) v(band, lo, hi, depth) UNION ALL SELECT c, band, depth, e + lo, least(coalesce(q, 64000) - 1, e + hi) FROM n, (VALUES ('proximal', 1, 500, 0.15::DOUBLE), ('mid', 501, 2000, 0.02::DOUBLE)) v(band, lo, hi, depth)),
t AS (SELECT DISTINCT c, i, CAST(1 + floor({_U.format(seed=35, key="c || ':' || i")} * (64000 - 501)) AS BIGINT) AS s FROM m, unnest(range(1, 101)) u(i)),
d AS (SELECT c, i, s FROM t WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.c = t.c AND greatest(1, m.s - 2000) <= t.s + 500 AND m.e + 2000 >= t.s)),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY i) AS rn FROM d)
SELECT c AS contig, 'target' AS band, 1.0::DOUBLE AS depth, s AS start, e AS "end" FROM m UNION ALL SELECT c, band, depth, s, e FROM o WHERE e - s + 1 >= 150 UNION ALL SELECT c, 'distal', 0.012::DOUBLE, s, s + 499 FROM r WHERE rn <= 40""")
def d17_capture_windows(t):
    """Padded and merged baits, bands beside them, and windows far from all of them."""
    x = F.col("o_orderkey") * 613 % 60000
    baits = t.orders.select(F.col("o_custkey").alias("contig"), F.greatest(F.lit(1), x + 1 - 100).alias("start"), (x + 200 + 100).alias("end"))
    spans = written(intervals.islands(baits, ["contig"], gap=200).drop("n").withColumn("length", F.lit(64000).cast("long")), "spans")
    bands = genome.off_target(spans, ["contig"], [("proximal", 1, 500, 0.15), ("mid", 501, 2000, 0.02)], "length", 150)
    far = genome.distal(dealt(spans.select("contig", "length").distinct()), spans, 40, 500, 2000, 35, 100)
    named = lambda d, band, depth: d.select("contig", F.lit(band).alias("band"), F.lit(depth).alias("depth"), "start", "end")
    return named(spans, "target", 1.0).unionByName(bands).unionByName(named(far, "distal", 0.012))


_RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
_AT = "substr({0}, CAST(greatest({1}, 1) AS BIGINT), CAST(greatest(0, {1} + 20 - greatest({1}, 1)) AS BIGINT))"  # 20 letters from a place


@query(f"""WITH {_P}, k AS (SELECT *, p_partkey // 8 AS contig, p_partkey % 8 * 64 AS base FROM p), g AS (SELECT contig, string_agg(dna, '' ORDER BY base) AS seq FROM k GROUP BY 1),
e AS (SELECT k.p_partkey AS event, ['DEL', 'DUP', 'INV', 'TRA', 'INS', 'VIRUS'][k.p_partkey % 6 + 1] AS kind, a.seq AS s, b.seq AS f, base + p_size AS x, base + p_size + 3 + 7 * (p_size % 5) AS y, substr(dna, 1, CAST(10 + p_size % 30 AS BIGINT)) AS el FROM k JOIN g a ON a.contig = k.contig JOIN g b ON b.contig = k.p_partkey // 16),
o AS (SELECT event, '' AS side, kind, CASE kind WHEN 'DEL' THEN {_AT.format("s", "x - 19")} || {_AT.format("s", "y")} WHEN 'TRA' THEN {_AT.format("s", "x - 19")} || {_AT.format("f", "y")} WHEN 'DUP' THEN {_AT.format("s", "y - 19")} || {_AT.format("s", "x")} ELSE {_AT.format("s", "x - 19")} || {_RC.format(_AT.format("s", "y - 19"))} END AS sequence FROM e WHERE kind NOT IN ('INS', 'VIRUS')
 UNION ALL SELECT event, '5p', kind, {_AT.format("s", "x - 19")} || substr(el, 1, 20) FROM e WHERE kind IN ('INS', 'VIRUS') UNION ALL SELECT event, '3p', kind, right(el, 20) || {_AT.format("s", "x + 1")} FROM e WHERE kind IN ('INS', 'VIRUS'))
SELECT * FROM o WHERE length(sequence) >= 20""")
def d18_junction_contigs(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    d = _dna(t)
    blocks = d.select(F.floor(k / 8).alias("contig"), (k % 8).alias("block"), F.col("dna").alias("seq"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("DEL", "DUP", "INV", "TRA", "INS", "VIRUS")]), (k % 6 + 1).cast("int"))
    start = k % 8 * 64 + size
    events = d.select(k.alias("event"), kind.alias("kind"), F.floor(k / 8).alias("contig"), start.alias("start"), F.floor(k / 16).alias("end_contig"), (start + 3 + size % 5 * 7).alias("end"), F.substring(F.col("dna"), F.lit(1), 10 + size % 30).alias("element"))
    return genome.junction_contigs(events, blocks, 64, 20)
