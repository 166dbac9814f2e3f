"""Composite queries: copy numbers, plans, grids, rosters, manifests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import editing
from ..functions import scalar as sc
from ..functions import sequence as sq
from ..operators import checks, copynumber, hierarchy, intervals, sampling, sets, windows
from ._dealt import dealt
from .interval_plans import _CLOSE, _TREE, _tree
from .registry import query
from .scalar_plans import _CODONS, _P, _dna

_PURITY = 0.7
_U = "(CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE)"


def _segments(t):
    region = t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("clone"), (F.col("r_regionkey") * 200).cast("long").alias("start"), (F.col("r_regionkey") * 200 + 700).cast("long").alias("end"), F.lit(2).alias("cn_a"), F.lit(0).alias("cn_b"), F.lit(-1).cast("long").alias("seg"))
    s = F.col("s_suppkey")
    own = t.supplier.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("clone"), (s * 10).alias("start"), (s * 10 + 150).alias("end"), (s % 5).cast("int").alias("cn_a"), (s % 3).cast("int").alias("cn_b"), s.alias("seg"))
    return region.unionByName(own)


_SEG = "seg AS (SELECT 'r' || r_regionkey AS clone, CAST(r_regionkey * 200 AS BIGINT) AS s, CAST(r_regionkey * 200 + 700 AS BIGINT) AS e, 2 AS cn_a, 0 AS cn_b, -1::BIGINT AS seg FROM region UNION ALL SELECT 'n' || s_nationkey, s_suppkey * 10, s_suppkey * 10 + 150, CAST(s_suppkey % 5 AS INTEGER), CAST(s_suppkey % 3 AS INTEGER), s_suppkey FROM supplier)"
_LINE = "line AS (SELECT ancestor, descendant, depth FROM clo UNION ALL SELECT node, node, 0 FROM tree)"


def _cn_sql(points: str) -> str:
    """cn: key, clone, cn_a, cn_b of points (key, clone, pos)."""
    return f"""{_TREE}, {_CLOSE}, {_SEG}, {_LINE}, pts AS ({points}),
    ranked AS (SELECT pts.key, pts.clone, seg.cn_a, seg.cn_b, row_number() OVER (PARTITION BY pts.key, pts.clone ORDER BY depth, seg.s DESC, seg.seg DESC) AS rn
               FROM pts JOIN line ON line.descendant = pts.clone JOIN seg ON seg.clone = line.ancestor AND pos >= seg.s AND pos < seg.e),
    cn AS (SELECT pts.key, pts.clone, coalesce(cn_a, 1) AS cn_a, coalesce(cn_b, 1) AS cn_b FROM pts LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) r ON r.key = pts.key AND r.clone = pts.clone)"""


def _customer_points(t):
    return t.customer.select(F.col("c_custkey").alias("key"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("clone"), F.col("c_custkey").alias("pos"))


@query(f"WITH RECURSIVE {_cn_sql("SELECT c_custkey AS key, 'n' || c_nationkey AS clone, c_custkey AS pos FROM customer")} SELECT key, clone, cn_a, cn_b FROM cn")
def d2_copy_number(t):
    return copynumber.copies_at(_customer_points(t), _segments(t), hierarchy.closure(_tree(t)), ["key"], 150)


_SITES = "SELECT p_partkey AS key, 'n' || n_nationkey AS clone, p_partkey AS pos FROM part, nation"
_F = "f AS (SELECT 'n' || c_nationkey AS clone, count(*) / (SELECT count(*) FROM customer)::DOUBLE AS f FROM customer GROUP BY 1)"


def _shares(t):
    counts = t.customer.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("clone")).count()
    every = Window.partitionBy(F.lit(0))  # a row a clone
    return counts.select("clone", (F.col("count") / F.sum("count").over(every)).alias("f"))


def _pieces(t):
    """Resolved pieces of the nations' clones."""
    return copynumber.resolved(_segments(t), hierarchy.closure(_tree(t)), 150).where("clone like 'n%'")


def _site_sums(t):
    """Sums over clones at every part's place: a row a part."""
    shares = _shares(t)
    sites = t.part.select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("pos"), "p_size")
    return copynumber.tile_sums(sites, ["key", "p_size"], copynumber.tiles(_pieces(t), shares, 150), shares, 150)


@query(f"WITH RECURSIVE {_cn_sql(_SITES)}, {_F}, m AS (SELECT cn.key, cn_a, cn_b, f, CASE WHEN p_size < 25 THEN cn_a WHEN cn_a >= 1 THEN 1 ELSE 0 END AS m FROM cn JOIN f USING (clone) JOIN part ON p_partkey = cn.key) SELECT key, round({_PURITY}::DOUBLE * sum(f * m) / ({_PURITY}::DOUBLE * sum(f * (cn_a + cn_b)) + 2 * (1 - {_PURITY}::DOUBLE)), 9) AS vaf FROM m GROUP BY key")
def d3_expected_fraction(t):
    carried = F.when(F.col("p_size") < 25, F.col("copies_a")).otherwise(F.col("present_a"))
    vaf = copynumber.expected_fraction(_PURITY, carried, F.col("copies_a") + F.col("copies_b"))
    return _site_sums(t).select("key", F.round(vaf, 9).alias("vaf"))


@query(f"WITH RECURSIVE {_cn_sql(_SITES)}, {_F}, w AS (SELECT key, clone AS source, u.hap, u.kind, CASE u.kind WHEN 'all' THEN {_PURITY}::DOUBLE * f ELSE {_PURITY}::DOUBLE * f * (CASE hap WHEN 0 THEN cn_a ELSE cn_b END - 1) END AS weight FROM cn JOIN f USING (clone), (VALUES (0, 'all'), (0, 'pre_cna'), (1, 'all'), (1, 'pre_cna')) u(hap, kind) WHERE CASE hap WHEN 0 THEN cn_a ELSE cn_b END > CASE kind WHEN 'all' THEN 0 ELSE 1 END) SELECT kind, hap, count(*) AS n, round(sum(weight), 6) AS weight FROM (SELECT * FROM w UNION ALL SELECT p_partkey, 'NORMAL', h, 'all', 1 - {_PURITY}::DOUBLE FROM part, (VALUES (0), (1)) v(h)) GROUP BY kind, hap")
def d4_source_plan(t):
    """The plan of each stretch between cut points, and what the parts in it add up to."""
    pieces, shares = _pieces(t), _shares(t)
    cuts = intervals.elementary(pieces.select("start", "end"), []).select(F.col("start").alias("tile"), "end")
    parts = t.part.select(F.col("p_partkey").alias("pos"))
    # Parts outside of all stretches are in one of their own, where every clone has one copy of each.
    placed = intervals.point_join(parts, cuts.withColumnRenamed("tile", "start"), [], width=150).groupBy(F.col("start").alias("tile")).agg(F.count(F.lit(1)).alias("parts"))
    outside = intervals.point_join(parts, cuts.withColumnRenamed("tile", "start"), [], width=150, how="left_anti").agg(F.lit(-1).cast("long").alias("tile"), F.count(F.lit(1)).alias("parts"))
    placed = placed.unionByName(outside).where("parts > 0")
    own = intervals.point_join(placed.withColumn("pos", F.col("tile")), pieces, [], width=150).select("tile", "clone", "cn_a", "cn_b")
    grid = sets.grid(placed.select("tile"), shares.select("clone"))  # stretches and clones, not places
    one = F.lit(1)
    copies = grid.join(own, ["tile", "clone"], "left").select("tile", "clone", F.coalesce("cn_a", one).alias("cn_a"), F.coalesce("cn_b", one).alias("cn_b")).join(shares, "clone")
    plan = copynumber.source_plan(copies, ["tile"], _PURITY).join(placed, "tile")
    return plan.groupBy("kind", "hap").agg(F.sum("parts").alias("n"), F.round(F.sum(F.col("weight") * F.col("parts")), 6).alias("weight"))


@query(f"WITH RECURSIVE {_cn_sql(_SITES)}, {_F} SELECT key, round(greatest(0.001, 60 * {_PURITY}::DOUBLE / ({_PURITY}::DOUBLE * sum(f * (cn_a + cn_b)) + 2 * (1 - {_PURITY}::DOUBLE))), 9) AS coverage FROM cn JOIN f USING (clone) GROUP BY key")
def d5_coverage(t):
    p = F.lit(_PURITY)
    denominator = p * (F.col("copies_a") + F.col("copies_b")) + 2 * (1 - p)
    return _site_sums(t).select("key", F.round(copynumber.coverage(60.0, p, denominator, F.lit(1.0)), 9).alias("coverage"))


@query(f"WITH RECURSIVE {_cn_sql("SELECT c_custkey AS key, 'n' || c_nationkey AS clone, c_custkey AS pos FROM customer")} SELECT clone, CAST(sum(cn_a) AS BIGINT) AS a, CAST(sum(cn_b) AS BIGINT) AS b, sum(cn_b) = 0 AS lost FROM cn GROUP BY clone")
def d8_retained_copies(t):
    cn = copynumber.copies_at(_customer_points(t), _segments(t), hierarchy.closure(_tree(t)), ["key"], 150)
    return cn.groupBy("clone").agg(F.sum("cn_a").alias("a"), F.sum("cn_b").alias("b"), (F.sum("cn_b") == 0).alias("lost"))


@query(f"WITH RECURSIVE {_cn_sql("SELECT c_custkey AS key, 'n' || c_nationkey AS clone, c_custkey AS pos FROM customer")}, x AS (SELECT key, cn_a, cn_b, CASE c_custkey % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.9 END::DOUBLE AS m, c_custkey // 3 % 3 AS mut, c_custkey % 4 + 1 AS ploidy FROM cn JOIN customer ON c_custkey = key), y AS (SELECT *, CASE WHEN cn_a > 0 AND cn_b > 0 AND m IS NOT NULL AND mut < 2 THEN CASE mut WHEN 0 THEN m ELSE 1 - m END ELSE coalesce(cn_a / nullif(cn_a + cn_b, 0)::DOUBLE, 0) END AS s FROM x) SELECT key, CAST(u.hap AS INTEGER) AS hap, round(CASE WHEN u.hap = 0 THEN s WHEN cn_a + cn_b > 0 THEN 1 - s ELSE 0 END, 9) AS share, round((cn_a + cn_b) / ploidy::DOUBLE, 9) AS dosage FROM y, (VALUES (0), (1)) u(hap)")
def d20_haplotype_shares(t):
    k = F.col("key")
    cn = copynumber.copies_at(_customer_points(t), _segments(t), hierarchy.closure(_tree(t)), ["key"], 150)
    setting = F.when(k % 3 == 0, "silenced").when(k % 3 == 1, "dominant").otherwise("balanced")
    out = copynumber.haplotype_shares(cn, ["key"], setting, F.floor(k / 3) % 3, k % 4 + 1)
    return out.withColumn("share", F.round("share", 9)).withColumn("dosage", F.round("dosage", 9))


@query()
def d6_consequence(t):
    d = _dna(t).select("p_partkey", F.concat(F.lit("ATG"), F.substring("dna", 1, 57), F.lit("TAA")).alias("cds"), F.substring("dna", 30, 30).alias("tail"), (F.col("p_size") % 60).cast("long").alias("pos"), F.substring("p_brand", 7, 1).alias("x"))
    d = d.withColumn("ref", F.substring(F.col("cds"), (F.col("pos") + 1).cast("int"), F.lit(1))).withColumn("alt", F.translate("x", "0123456789", "ACGTACGTAC"))
    return d.select("p_partkey", editing.consequence("cds", "tail", "pos", "ref", "alt").alias("c")).groupBy("c.consequence").agg(F.count(F.lit(1)).alias("n"))


@query("WITH cells AS (SELECT s, p, k FROM (SELECT DISTINCT c_mktsegment AS s FROM customer), (SELECT DISTINCT o_orderpriority AS p FROM orders), unnest(range(1, 4)) u(k)), r AS (SELECT c_mktsegment AS s, o_orderpriority AS p, o_orderkey, row_number() OVER (PARTITION BY c_mktsegment, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND o_totalprice > 300000) SELECT s, p, CAST(cells.k AS INTEGER) AS k, o_orderkey, o_orderkey IS NOT NULL AS filled FROM cells LEFT JOIN r USING (s, p, k)")
def d9_grid_fill(t):
    k = t.spark.range(1, 4).select(F.col("id").cast("int").alias("k"))
    cells = sets.grid(t.customer.select(F.col("c_mktsegment").alias("s")), t.orders.select(F.col("o_orderpriority").alias("p")), k)
    d = t.orders.where("o_orderstatus = 'F' and o_totalprice > 300000").join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_mktsegment").alias("s"), F.col("o_orderpriority").alias("p"), "o_orderkey", "o_totalprice")
    r = windows.numbered(d, [F.col("o_totalprice").desc(), "o_orderkey"], "k", ["s", "p"]).where("k <= 3").select("s", "p", "k", "o_orderkey")
    return cells.join(r, ["s", "p", "k"], "left").select("s", "p", "k", "o_orderkey", F.col("o_orderkey").isNotNull().alias("filled"))


@query("WITH d AS (SELECT c_custkey, c_mktsegment, coalesce(CASE WHEN c_acctbal > 5000 THEN c_acctbal END, CASE WHEN c_acctbal > 0 THEN c_acctbal / 2 END, 0) AS score FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY score DESC, c_custkey) AS k FROM d), f AS (SELECT *, row_number() OVER (ORDER BY (k > 2)::INT, score DESC, c_custkey) AS pick FROM r) SELECT c_custkey, score, pick FROM f WHERE pick <= 40 OR k <= 2")
def d10_promotion(t):
    bal = F.col("c_acctbal")
    d = t.customer.withColumn("score", F.coalesce(F.when(bal > 5000, bal), F.when(bal > 0, bal / 2), F.lit(0.0)))
    return windows.floor_then_fill(d, ["c_mktsegment"], [F.col("score").desc(), F.col("c_custkey")], 2, 40).select("c_custkey", "score", F.col("pick").cast("long"))


@query(f"WITH n AS (SELECT p_brand, CAST(round(0.1 * count(*)) AS BIGINT) AS n FROM part GROUP BY 1), r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY substr(md5('31:' || p_partkey), 1, 12), p_partkey) AS rn FROM part) SELECT p_partkey, CASE WHEN {_U.format(seed=32, key='p_partkey')} < 0.6 THEN 'trunk' ELSE 'branch' END AS clone, {_U.format(seed=33, key='p_partkey')} < 0.08 AS indel FROM r JOIN n USING (p_brand) WHERE rn <= n")
def d11_background(t):
    n = t.part.groupBy("p_brand").agg(F.round(F.count(F.lit(1)) * 0.1).cast("long").alias("n"))
    d = windows.numbered(t.part.select("p_brand", "p_partkey"), sampling.shuffled(31, "p_partkey"), by=["p_brand"]).join(n, "p_brand").where("rn <= n")
    return d.select("p_partkey", F.when(sampling.uniform(32, "p_partkey") < 0.6, "trunk").otherwise("branch").alias("clone"), (sampling.uniform(33, "p_partkey") < 0.08).alias("indel"))


@query("WITH RECURSIVE r AS (SELECT p_brand, p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS s, CAST(floor(p_retailprice) AS BIGINT) + p_size AS e, row_number() OVER (PARTITION BY p_brand ORDER BY CAST(floor(p_retailprice) AS BIGINT), CAST(floor(p_retailprice) AS BIGINT) + p_size, p_partkey) AS k FROM part), f AS (SELECT p_brand, k, p_partkey, true AS kept, e AS last FROM r WHERE k = 1 UNION ALL SELECT r.p_brand, r.k, r.p_partkey, r.s >= f.last, CASE WHEN r.s >= f.last THEN r.e ELSE f.last END FROM f JOIN r ON r.p_brand = f.p_brand AND r.k = f.k + 1) SELECT p_partkey, kept FROM f")
def d12_placement_with_reservation(t):
    d = t.part.select("p_brand", "p_partkey", F.floor("p_retailprice").alias("start"), (F.floor("p_retailprice") + F.col("p_size")).alias("end"))
    return intervals.greedy(d, ["p_brand"], "p_partkey").select("p_partkey", "kept")


@query()
def d14_haplotype_edits(t):
    letter = lambda at: F.substring(F.col("dna"), at, F.lit(1))
    at = [F.col("p_size") % 30 + 1, F.col("p_size") % 30 + 2, F.col("p_size") % 7 + 40]
    edits = F.array(*[F.struct((a - 1).cast("long").alias("pos"), (letter(a) if i != 1 else F.lit("A")).alias("ref"), F.lit(("ACG", "*", "")[i]).alias("alt")) for i, a in enumerate(at)])
    d = _dna(t).select("p_partkey", editing.apply_edits("dna", edits).alias("e"))
    return d.groupBy("e.applied", F.array_join("e.rejected", ",").alias("rejected")).agg(F.count(F.lit(1)).alias("n"))


@query()
def d36_normalised_variants(t):
    d = _dna(t).select("p_partkey", "dna", (F.col("p_size") % 40 + 2).cast("long").alias("pos"))
    d = d.withColumn("ref", F.substring(F.col("dna"), (F.col("pos") + 1).cast("int"), F.lit(2))).withColumn("alt", F.substring("ref", 1, 1))
    d = d.withColumn("v", editing.left_align("dna", "pos", "ref", "alt"))
    whole = lambda p, r, a: F.concat(F.substring(F.col("dna"), F.lit(1), p.cast("int")), a, F.substring(F.col("dna"), (p + F.length(r) + 1).cast("int"), F.lit(64)))
    same = whole(F.col("pos"), F.col("ref"), F.col("alt")) == whole(F.col("v.pos"), F.col("v.ref"), F.col("v.alt"))
    return d.select("p_partkey", "v.pos", "v.ref", "v.alt", same.alias("same_sequence"))


@query(f"SELECT s_suppkey, round({_PURITY}::DOUBLE * (s_nationkey / 25.0) * (1 + s_suppkey % 4), 9) AS weight FROM supplier")
def d19_payload_weight(t):
    return t.supplier.select("s_suppkey", F.round(F.lit(_PURITY) * (F.col("s_nationkey") / 25.0) * (1 + F.col("s_suppkey") % 4), 9).alias("weight"))


_SOURCES = (("n1", 0.6), ("n7", 0.3))  # clones; the normal, on both haplotypes alike, has the rest


@query(f"WITH RECURSIVE {_cn_sql("SELECT p_partkey AS key, v.clone, p_partkey % 1100 AS pos FROM part, (VALUES ('n1'), ('n7')) v(clone)")}, s AS (SELECT key, clone AS source, CASE clone WHEN 'n1' THEN 0.6 ELSE 0.3 END AS w, cn_a / nullif(cn_a + cn_b, 0)::DOUBLE AS a, (cn_a + cn_b) / 2.0 AS dose FROM cn UNION ALL SELECT p_partkey, 'NORMAL', 0.1, 0.5, 1.0 FROM part), r AS (SELECT key, source, u.hap, p_retailprice * dose * CASE u.hap WHEN 0 THEN a ELSE 1 - a END * w AS ab FROM s JOIN part ON p_partkey = key, (VALUES (0), (1)) u(hap) WHERE (p_retailprice >= 1200 OR p_size % 10 = 0) AND p_size * 10 >= 150 AND CASE u.hap WHEN 0 THEN a ELSE 1 - a END > 0) SELECT source, CAST(hap AS INTEGER) AS hap, count(*) AS records, round(sum(ab), 3) AS abundance FROM r GROUP BY ALL")
def d21_record_assembly(t):
    """Transcript x source x haplotype, by each clone's copies at the transcript's place."""
    clones = F.explode(F.array(*[F.struct(F.lit(c).alias("clone"), F.lit(w).alias("w")) for c, w in _SOURCES])).alias("c")
    points = t.part.select(F.col("p_partkey").alias("key"), (F.col("p_partkey") % 1100).alias("pos"), clones).select("key", "pos", "c.clone")
    cn = copynumber.copies_at(points, _segments(t), hierarchy.closure(_tree(t)), ["key"], 150)
    weight = F.when(F.col("clone") == _SOURCES[0][0], _SOURCES[0][1]).otherwise(_SOURCES[1][1])
    tumour = copynumber.haplotype_shares(cn, ["key", "clone"], F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(2)).select("key", F.col("clone").alias("source"), "hap", "share", "dosage", weight.alias("w"))
    normal = t.part.select(F.col("p_partkey").alias("key"), F.lit("NORMAL").alias("source"), F.posexplode(F.array(F.lit(0.5), F.lit(0.5))).alias("hap", "share"), F.lit(1.0).alias("dosage"), F.lit(0.1).alias("w"))
    d = tumour.unionByName(normal).join(t.part.select("p_partkey", "p_retailprice", "p_size", (F.col("p_size") * 10).alias("length_")), F.col("key") == F.col("p_partkey"))
    d = copynumber.expressed_records(d, "p_retailprice", "w", "length_", 150, 1200, F.col("p_size") % 10 == 0)
    return d.groupBy("source", "hap").agg(F.count(F.lit(1)).alias("records"), F.round(F.sum("expressed"), 3).alias("abundance"))


@query("WITH d AS (SELECT p_retailprice AS ab, p_size + 50 AS len_ FROM part), k AS (SELECT 1000000.0 * 2 * 100 / sum(ab * len_) AS k FROM d), c AS (SELECT ab * k AS cov, len_, CAST(greatest(0, least(59, floor((log10(ab * k) + 1) / 0.1))) AS BIGINT) AS bin FROM d, k) SELECT bin, count(*) AS n, round(sum(cov * len_) / sum(len_), 6) AS coverage FROM c GROUP BY bin")
def d22_coverage_plan(t):
    d = t.part.select(F.col("p_retailprice").alias("ab"), (F.col("p_size") + 50).alias("len_"))
    k = d.agg((F.lit(1000000.0 * 2 * 100) / F.sum(F.col("ab") * F.col("len_"))).alias("k"))
    d = d.crossJoin(F.broadcast(k)).withColumn("cov", F.col("ab") * F.col("k")).withColumn("bin", sc.log_bin(F.col("cov"), -1, 0.1, 60))  # k is one row
    return d.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("cov") * F.col("len_")) / F.sum("len_"), 6).alias("coverage"))


@query("WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1), e AS (SELECT c_mktsegment, n * 400 / sum(n) OVER ()::DOUBLE AS x FROM c), f AS (SELECT c_mktsegment, floor(x) AS base, row_number() OVER (ORDER BY x - floor(x) DESC, c_mktsegment) AS k, 400 - sum(floor(x)) OVER () AS l FROM e), s AS (SELECT c_mktsegment, base + CASE WHEN k <= l THEN 1 ELSE 0 END AS seats FROM f), r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY substr(md5('41:' || c_custkey), 1, 12), c_custkey) AS rn FROM customer) SELECT c_custkey, c_mktsegment, substr(md5('42:' || c_custkey), 1, 3) < '0f5' AS doublet FROM r JOIN s USING (c_mktsegment) WHERE rn <= seats")
def d23_cell_roster(t):
    seats = windows.apportion(t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "n", 400, ["c_mktsegment"]).select("c_mktsegment", "seats")
    d = windows.numbered(t.customer.select("c_custkey", "c_mktsegment"), sampling.shuffled(41, "c_custkey"), by=["c_mktsegment"]).join(seats, "c_mktsegment").where("rn <= seats")
    return d.select("c_custkey", "c_mktsegment", (F.substring(sampling.token(42, "c_custkey"), 1, 3) < "0f5").alias("doublet"))


@query(f"WITH k AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'other' ELSE 'n' || c_nationkey % 3 END AS class, c_custkey AS key FROM customer), n AS (SELECT *, greatest(50, trunc(60 + 21 * sqrt(-2 * ln(1 - {_U.format(seed='44:a', key='key')})) * cos(2 * pi() * {_U.format(seed='44:b', key='key')}))) AS n FROM k), w AS (SELECT p_partkey, class, CASE WHEN class = 'other' THEN CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END WHEN p_size % 5 = 0 AND class <> 'n' || p_size % 3 THEN 0 ELSE p_size * ((p_partkey + length(class) + ascii(right(class, 1))) % 4) END::DOUBLE AS w FROM part, (SELECT DISTINCT class FROM k)), c AS (SELECT class, p_partkey, (sum(w) OVER o - w) / sum(w) OVER (PARTITION BY class) AS lo, sum(w) OVER o / sum(w) OVER (PARTITION BY class) AS hi FROM w WHERE w > 0 WINDOW o AS (PARTITION BY class ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)), m AS (SELECT c_custkey, class, c_custkey || ':' || i AS molecule FROM n, unnest(range(0, CAST(n AS BIGINT))) u(i)), d AS (SELECT *, {_U.format(seed=43, key='molecule')} AS u FROM m) SELECT c_custkey, count(*) AS molecules, count(DISTINCT p_partkey) AS records FROM d JOIN c ON c.class = d.class AND u >= lo AND u < hi GROUP BY 1")
def d24_molecule_pool(t):
    """A cell draws a number of molecules of its own, from its class's table: designed
    transcripts (every fifth size) only in their clone, others by the clone's copies."""
    size = F.col("p_size")
    k = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "other").otherwise(F.concat(F.lit("n"), (F.col("c_nationkey") % 3).cast("string"))).alias("class"))
    n = F.greatest(F.lit(50), (60 + 21 * sampling.normal(44, "c_custkey")).cast("int"))
    draws = dealt(k).withColumn("i", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("molecule", F.concat(F.col("c_custkey").cast("string"), F.lit(":"), F.col("i").cast("string")))
    copies = (F.col("p_partkey") + F.length("class") + F.ascii(F.right("class", F.lit(1)))) % 4
    weight = F.when(F.col("class") == "other", F.when(size % 5 == 0, 0).otherwise(size)).when((size % 5 == 0) & (F.col("class") != F.concat(F.lit("n"), (size % 3).cast("string"))), 0).otherwise(size * copies)
    table = t.part.crossJoin(F.broadcast(k.select("class").distinct())).select("p_partkey", "class", weight.cast("double").alias("w"))  # four classes
    out = sampling.weighted_draws(table, "p_partkey", "w", draws, "molecule", 43, by=["class"], buckets=F.floor(F.col("p_partkey") / 1000))
    return out.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("molecules"), F.countDistinct("p_partkey").alias("records"))


@query(f"WITH {_P}, {_CODONS}, r AS (SELECT p_partkey, 'TGTGCC' || replace(replace(replace(substr(dna, 1, 3 * (3 + p_size % 4)), 'T', 'A'), 'AA', 'GC'), 'TA', 'CA') || 'TTC' AS nt FROM p), e AS (SELECT p_partkey, nt, k, substr(nt, k * 3 + 1, 3) AS codon FROM r, unnest(range(0, 12)) u(k) WHERE k * 3 + 3 <= length(nt)) SELECT p_partkey, any_value(nt) AS cdr3_nt, string_agg(aa, '' ORDER BY k) AS cdr3_aa FROM e JOIN codons USING (codon) GROUP BY 1")
def d25_recombination(t):
    insert = F.substring(F.col("dna"), F.lit(1), (F.col("p_size") % 4 + 3) * 3)
    insert = F.replace(F.replace(F.replace(insert, F.lit("T"), F.lit("A")), F.lit("AA"), F.lit("GC")), F.lit("TA"), F.lit("CA"))  # no T: no stop codon
    d = _dna(t).select("p_partkey", F.concat(F.lit("TGTGCC"), insert, F.lit("TTC")).alias("cdr3_nt"))
    return d.withColumn("cdr3_aa", sq.translate(F.col("cdr3_nt")))


@query(f"WITH RECURSIVE r AS (SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem), z AS (SELECT DISTINCT l_suppkey, n FROM r), a AS (SELECT l_suppkey, n, CAST(i AS BIGINT) AS arr, CAST(least(8, greatest(1, 9 - floor(pow({_U.format(seed=45, key="l_suppkey || ':' || i")}, 2) * 9))) AS BIGINT) AS size FROM z, unnest(range(0, n)) u(i)), c AS (SELECT *, CAST(sum(size) OVER (PARTITION BY l_suppkey ORDER BY arr) AS BIGINT) AS upto FROM a) SELECT r.l_suppkey, arr, count(*) AS members, string_agg('[' || (k - (upto - size)) || ']' || l_partkey, '' ORDER BY k) || '[' || count(*) || ']' AS text FROM r JOIN c ON c.l_suppkey = r.l_suppkey AND k >= upto - size AND k < upto GROUP BY r.l_suppkey, arr")
def d26_array_grammar(t):
    """Up to eight members by a drawn yield, each behind its adapter, and the closing one."""
    size = 9 - F.floor(F.pow(sampling.uniform(45, "l_suppkey", "array"), 2) * 9)
    d = windows.packed(t.lineitem, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"], size, 8)
    one = F.struct("member", F.concat(F.lit("["), F.col("member").cast("string"), F.lit("]"), F.col("l_partkey").cast("string")).alias("s"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]), "")
    n = F.count(F.lit(1))
    return d.groupBy("l_suppkey", F.col("array").alias("arr")).agg(n.alias("members"), F.concat(joined, F.lit("["), n.cast("string"), F.lit("]")).alias("text"))


@query("WITH w AS (SELECT DISTINCT item_id, x FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS x FROM benchmark)), a AS (SELECT DISTINCT x FROM (SELECT unnest(string_split(lower(text), ' ')) AS x FROM conversations WHERE role = 'user')), b AS (SELECT DISTINCT x FROM (SELECT unnest(string_split(lower(text), ' ')) AS x FROM conversations WHERE role = 'assistant')), c AS (SELECT item_id, count(a.x) / count(*)::DOUBLE AS in_a, count(b.x) / count(*)::DOUBLE AS in_b FROM w LEFT JOIN a USING (x) LEFT JOIN b USING (x) GROUP BY 1) SELECT item_id, round(in_a, 9) AS in_a, round(in_b, 9) AS in_b, CASE WHEN abs(in_a - in_b) < 0.02 THEN 'indeterminate' WHEN in_a > in_b THEN 'a' ELSE 'b' END AS phase FROM c")
def d27_phase_by_containment(t):
    words = lambda df, name: df.select(F.explode(F.split(F.lower("text"), " ")).alias("x")).distinct().withColumn(name, F.lit(1))
    w = t.benchmark.select("item_id", F.explode(F.split(F.lower("text"), " ")).alias("x")).distinct()
    c = w.join(words(t.conversations.where("role = 'user'"), "a"), "x", "left").join(words(t.conversations.where("role = 'assistant'"), "b"), "x", "left")
    c = c.groupBy("item_id").agg((F.count("a") / F.count(F.lit(1))).alias("in_a"), (F.count("b") / F.count(F.lit(1))).alias("in_b"))
    phase = F.when(F.abs(F.col("in_a") - F.col("in_b")) < 0.02, "indeterminate").when(F.col("in_a") > F.col("in_b"), "a").otherwise("b")
    return c.select("item_id", F.round("in_a", 9).alias("in_a"), F.round("in_b", 9).alias("in_b"), phase.alias("phase"))


@query("WITH x AS (SELECT l_partkey, l_linenumber AS s, l_linenumber + l_quantity / 10 AS e, l_suppkey % 2 AS hap, l_orderkey FROM lineitem), f AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY l_partkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM x), g AS (SELECT *, sum(fresh) OVER (PARTITION BY l_partkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT l_partkey, CAST(min(s) AS DOUBLE) AS start, max(e) AS \"end\", count(*) FILTER (hap = 0) AS hap0, count(*) FILTER (hap = 1) AS hap1 FROM g GROUP BY l_partkey, k")
def d28_merged_records(t):
    d = t.lineitem.select("l_partkey", F.col("l_linenumber").cast("double").alias("start"), (F.col("l_linenumber") + F.col("l_quantity") / 10).alias("end"), (F.col("l_suppkey") % 2).alias("hap"))
    return intervals.islands(d, ["l_partkey"], hap0=F.count_if(F.col("hap") == 0), hap1=F.count_if(F.col("hap") == 1)).drop("n")


@query(f"WITH v AS (SELECT l_suppkey, sum((l_returnflag = 'A')::INT) < sum((l_returnflag <> 'A')::INT) AS flip FROM lineitem GROUP BY 1) SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'panel' WHEN flip IS NOT NULL THEN 'reads' ELSE 'random' END AS source, CASE WHEN s_nationkey < 5 THEN CAST(s_nationkey % 2 AS INTEGER) WHEN flip IS NOT NULL THEN CASE WHEN flip THEN 1 ELSE 0 END ELSE CASE WHEN {_U.format(seed=51, key='s_suppkey')} < 0.5 THEN 0 ELSE 1 END END AS phase FROM supplier LEFT JOIN v ON l_suppkey = s_suppkey")
def d29_phase_combination(t):
    votes = sets.majority_flip(t.lineitem, ["l_suppkey"], F.col("l_returnflag") == "A").select("l_suppkey", "flip")
    d = t.supplier.join(votes, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    panel = F.col("s_nationkey") < 5
    source = F.when(panel, "panel").when(F.col("flip").isNotNull(), "reads").otherwise("random")
    phase = F.when(panel, (F.col("s_nationkey") % 2).cast("int")).when(F.col("flip").isNotNull(), F.col("flip").cast("int")).otherwise((sampling.uniform(51, "s_suppkey") >= 0.5).cast("int"))
    return d.select("s_suppkey", source.alias("source"), phase.alias("phase"))


@query(f"WITH {_P}, {_CODONS} SELECT p_partkey, codon, aa, CASE WHEN aa = substr('MKLV', CAST(p_partkey % 4 + 1 AS BIGINT), 1) THEN 'PASS' ELSE 'FAIL (residue differs)' END AS verdict FROM (SELECT p_partkey, substr(dna, 1 + 3 * (p_size % 20), 3) AS codon FROM p) JOIN codons USING (codon)")
def d30_spike_in_expectation(t):
    d = _dna(t).select("p_partkey", F.substring(F.col("dna"), (F.col("p_size") % 20) * 3 + 1, F.lit(3)).alias("codon")).withColumn("aa", sq.translate(F.col("codon")))
    want = F.substring(F.lit("MKLV"), (F.col("p_partkey") % 4 + 1).cast("int"), F.lit(1))
    return d.select("p_partkey", "codon", "aa", F.when(F.col("aa") == want, "PASS").otherwise("FAIL (residue differs)").alias("verdict"))


@query("WITH m AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN r_name WHEN o_orderstatus = 'O' THEN n_name ELSE 'always' END AS place, CASE WHEN o_orderstatus = 'P' THEN true ELSE r_regionkey < 3 END AS keep FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey) SELECT l_orderkey, l_linenumber, l_partkey, place FROM lineitem JOIN m ON o_orderkey = l_orderkey WHERE keep")
def d32_subset_by_record_map(t):
    """An order whose place can't be found ends the job."""
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.customer.join(F.broadcast(place), F.col("n_nationkey") == F.col("c_nationkey"), "left").select("c_custkey", "n_name", "r_name", "r_regionkey")
    m = t.orders.join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    name = F.when(F.col("o_orderstatus") == "F", F.col("r_name")).when(F.col("o_orderstatus") == "O", F.col("n_name")).otherwise("always")
    known = sets.resolved_or_error(name, F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
    m = m.select("o_orderkey", known.alias("place"), ((F.col("o_orderstatus") == "P") | (F.col("r_regionkey") < 3)).alias("keep")).where("keep or place is null")
    return t.lineitem.join(m, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "place")


@query("SELECT p_type AS class, count(*) AS designed, count(*) FILTER (p_size > 10) AS reachable, count(*) FILTER (p_size > 10 AND sold) AS observed, CASE WHEN count(*) FILTER (p_size > 10) > 0 AND count(*) FILTER (p_size > 10 AND sold) = 0 THEN 'FAIL (reachable but absent)' WHEN count(*) FILTER (p_size > 10 AND sold) < count(*) FILTER (p_size > 10) THEN 'FAIL (some absent)' ELSE 'PASS' END AS verdict FROM (SELECT *, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) AS sold FROM part) GROUP BY 1")
def d33_class_presence(t):
    sold = t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("k")).distinct().withColumn("sold", F.lit(True))
    d = t.part.join(sold, F.col("p_partkey") == F.col("k"), "left")
    reach = F.col("p_size") > 10
    out = d.groupBy(F.col("p_type").alias("class")).agg(F.count(F.lit(1)).alias("designed"), F.count_if(reach).alias("reachable"), F.count_if(reach & F.col("sold")).alias("observed"))
    verdict = F.when((F.col("reachable") > 0) & (F.col("observed") == 0), "FAIL (reachable but absent)").when(F.col("observed") < F.col("reachable"), "FAIL (some absent)").otherwise("PASS")
    return out.withColumn("verdict", verdict)


@query("SELECT r_name AS dataset, k AS sample, lower(r_name) || '_' || k || '_run' || chr(CAST(64 + row_number() OVER (PARTITION BY r_name ORDER BY k) AS INTEGER)) AS run_name FROM region, (VALUES ('normal'), ('rna'), ('tumour')) v(k)")
def d34_manifest(t):
    kinds = F.explode(F.array(F.lit("normal"), F.lit("rna"), F.lit("tumour"))).alias("sample")
    d = windows.numbered(t.region.select(F.col("r_name").alias("dataset"), kinds), ["sample"], by=["dataset"])
    return d.select("dataset", "sample", F.concat_ws("_", F.lower("dataset"), "sample", F.concat(F.lit("run"), F.chr(F.col("rn") + 64))).alias("run_name"))


@query(f"WITH {_P} SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN body ELSE reverse(translate(body, 'ACGT', 'TGCA')) END || substr(dna, 1, 8) AS inserted FROM (SELECT p_partkey, dna, p_size, right(dna, 40 - p_size % 20) || repeat('A', 10 + p_size % 20) AS body FROM p)")
def d38_element_insertion(t):
    """The donor's end, a poly-A tail that fills the length, either strand, and the doubled target site."""
    n = F.col("p_size") % 20
    body = F.concat(F.right(F.col("dna"), 40 - n), F.repeat(F.lit("A"), n + 10))
    d = _dna(t).withColumn("body", body)
    return d.select("p_partkey", F.concat(F.when(F.col("p_size") % 2 == 0, F.col("body")).otherwise(sq.reverse_complement(F.col("body"))), F.substring("dna", 1, 8)).alias("inserted"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'no completion record' WHEN o_orderpriority <> '1-URGENT' AND o_orderpriority <> '2-HIGH' THEN 'other code' WHEN c_custkey IS NULL THEN 'read map is gone' WHEN coalesce(n, 0) <> o_orderkey % 4 + 2 THEN 'truncated' END AS blocked FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def d40_resume_legality(t):
    """Record, code stamp, read map and number of reads, in this order."""
    found = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    maps = t.customer.where("c_acctbal > 0").select("c_custkey")
    d = t.orders.join(maps, F.col("c_custkey") == F.col("o_custkey"), "left").join(found, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    why = checks.resume_block(F.col("o_orderstatus") != "P", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("c_custkey").isNotNull(), F.col("o_orderkey") % 4 + 2, F.coalesce("n", F.lit(0).cast("long")))
    return d.select("o_orderkey", why.alias("blocked"))


@query("SELECT event_type, count(*) AS files, CAST(sum(coalesce(CAST(json_extract(props, '$.reads') AS BIGINT), CAST(json_extract(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS reads FROM events GROUP BY 1")
def d41_sidecar_summary(t):
    p = F.from_json("props", "reads long, k long")
    return t.events.select("event_type", F.coalesce(p["reads"], p["k"], F.lit(0).cast("long")).alias("n")).groupBy("event_type").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("reads"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) + 3 AS matched, 1 AS substituted, 2 AS inserted, CAST(l_linenumber AS BIGINT) AS deleted FROM lineitem")
def f28_difference_text(t):
    """:n matches, *xy substitutions, +bases insertions, -bases deletions."""
    text = F.concat(F.lit(":"), F.col("l_quantity").cast("int").cast("string"), F.lit("*ac+gt:3-"), F.repeat(F.lit("a"), F.col("l_linenumber")))
    hits = lambda p: F.regexp_extract_all("cs", F.lit(p), F.lit(1))
    total = lambda p: F.aggregate(hits(p), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    d = t.lineitem.withColumn("cs", text)
    matched = F.aggregate(hits(":([0-9]+)"), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", matched.alias("matched"), F.size(hits(r"(\*[a-z]{2})")).alias("substituted"), total(r"\+([a-z]+)").cast("int").alias("inserted"), total("-([a-z]+)").alias("deleted"))


@query("WITH want AS (SELECT * FROM (VALUES ('click'), ('view'), ('purchase'), ('refund')) v(component)), have AS (SELECT DISTINCT event_type AS component FROM events) SELECT coalesce(want.component, have.component) AS component, CASE WHEN have.component IS NULL THEN CASE WHEN want.component = 'refund' THEN 'absent, allowed' ELSE 'FAIL (absent)' END WHEN want.component IS NULL THEN 'not declared' ELSE 'present' END AS status FROM want FULL JOIN have ON want.component = have.component")
def d35_bundle_components(t):
    want = t.spark.createDataFrame([("click", False), ("view", False), ("purchase", False), ("refund", True)], "w string, allowed boolean")
    have = t.events.select(F.col("event_type").alias("h")).distinct()
    j = want.join(have, F.col("w") == F.col("h"), "full")
    status = F.when(F.col("w").isNull(), "not declared").when(F.col("h").isNotNull(), "present").when(F.col("allowed"), "absent, allowed").otherwise("FAIL (absent)")
    return j.select(F.coalesce("w", "h").alias("component"), status.alias("status"))


@query("SELECT conv_id, count(*) AS chunks, max(turn) + 1 AS expected, CASE WHEN count(*) <> max(turn) + 1 THEN 'FAIL (missing chunk)' WHEN count(*) FILTER (length(text) = 0) > 0 THEN 'FAIL (bad framing)' ELSE 'PASS' END AS verdict FROM conversations GROUP BY 1")
def d39_chunk_guard(t):
    d = t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks"), (F.max("turn") + 1).alias("expected"), F.count_if(F.length("text") == 0).alias("empty"))
    return d.select("conv_id", "chunks", "expected", F.when(F.col("chunks") != F.col("expected"), "FAIL (missing chunk)").when(F.col("empty") > 0, "FAIL (bad framing)").otherwise("PASS").alias("verdict"))
