"""Interval operators on events (per user) and on shipments (per customer)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, hierarchy, intervals, sets
from ._times import HOUR, days, micros
from .registry import query

_DAY = 24 * HOUR
_EV = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events)"
_SPAN = f"w AS (SELECT event_id AS w_id, user_id, value AS w_value, us AS s, us + {HOUR} AS t FROM e WHERE event_type = 'purchase')"


def _events(t):
    return t.events.select("event_id", "user_id", "event_type", "value", micros("ts").alias("us"))


def _spans(t, kind="purchase", hours=1):
    e = _events(t).where(F.col("event_type") == kind)
    return e.select("user_id", F.col("event_id").alias("w_id"), F.col("value").alias("w_value"), F.col("us").alias("start"), (F.col("us") + hours * HOUR).alias("end"))


def _spans_sql(kind, hours=1, name="w"):
    return f"{name} AS (SELECT event_id AS w_id, user_id, value AS w_value, us AS s, us + {hours * HOUR} AS t FROM e WHERE event_type = '{kind}')"


@query(f"WITH {_EV}, {_spans_sql('purchase', 6, 'a')}, {_spans_sql('view', 6, 'b')} SELECT a.user_id, a.w_id AS a_id, b.w_id AS b_id, least(a.t, b.t) - greatest(a.s, b.s) AS overlap FROM a JOIN b ON a.user_id = b.user_id AND a.t > b.s AND a.s < b.t")
def j3_interval_overlap(t):
    j = intervals.overlap_join(_spans(t, "purchase", 6), _spans(t, "view", 6), ["user_id"], 6 * HOUR, longest=6 * HOUR)
    return j.select("user_id", F.col("w_id").alias("a_id"), F.col("b_w_id").alias("b_id"), (F.least("end", "b_end") - F.greatest("start", "b_start")).alias("overlap"))


@query(f"WITH {_EV}, {_SPAN} SELECT e.event_id, w.w_id FROM e JOIN w ON e.user_id = w.user_id AND e.us >= w.s AND e.us < w.t")
def j4_point_in_interval(t):
    return intervals.point_join(_events(t), _spans(t), ["user_id"], "us", width=HOUR, longest=HOUR).select("event_id", "w_id")


@query(f"WITH {_EV}, {_spans_sql('purchase', 6, 'a')}, {_spans_sql('error', 6, 'b')} SELECT w_id FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.user_id = b.user_id AND a.t > b.s AND a.s < b.t)")
def j5_interval_semi_join(t):
    return intervals.overlap_semi(_spans(t, "purchase", 6), _spans(t, "error", 6), ["user_id"], 6 * HOUR, longest=6 * HOUR).select("w_id")


@query(f"WITH {_EV}, {_spans_sql('purchase', 6, 'a')}, {_spans_sql('error', 6, 'b')} SELECT w_id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.user_id = b.user_id AND a.t > b.s AND a.s < b.t)")
def j5_interval_anti_join(t):
    return intervals.overlap_semi(_spans(t, "purchase", 6), _spans(t, "error", 6), ["user_id"], 6 * HOUR, anti=True, longest=6 * HOUR).select("w_id")


@query(f"WITH {_EV}, c AS (SELECT event_id, user_id, us FROM e WHERE event_type = 'purchase'), v AS (SELECT user_id, us, max(event_id) AS view_id FROM e WHERE event_type = 'view' GROUP BY ALL) SELECT c.event_id, v.view_id FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.us >= v.us")
def j6_asof_join(t):
    e = _events(t)
    views = e.where("event_type = 'view'").select("user_id", "us", F.col("event_id").alias("view_id"))
    return intervals.asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "us"), views, ["user_id"], "us", ["view_id"], width=_DAY).select("event_id", "view_id")


@query(f"WITH {_EV}, {_SPAN}, c AS (SELECT * FROM e WHERE event_type = 'click') SELECT c.event_id, min(least(c.us - w.s, w.t - 1 - c.us)) AS edge FROM c LEFT JOIN w ON c.user_id = w.user_id AND c.us >= w.s AND c.us < w.t GROUP BY c.event_id")
def j6_edge_distance(t):
    return intervals.edge_distance(_events(t).where("event_type = 'click'"), _spans(t), ["user_id"], ["event_id"], "us", width=HOUR)


@query(f"WITH {_EV}, p AS (SELECT event_id, user_id, us FROM e WHERE event_type = 'purchase') SELECT a.event_id AS a_id, b.event_id AS b_id, b.us - a.us AS apart FROM p a JOIN p b ON a.user_id = b.user_id AND (b.us > a.us OR b.us = a.us AND b.event_id > a.event_id) AND b.us - a.us <= {12 * HOUR}")
def j11_pairs_within_distance(t):
    p = _events(t).where("event_type = 'purchase'").select("event_id", "user_id", "us")
    spans = p.select("user_id", F.col("event_id").alias("a_id"), F.col("us").alias("start"), (F.col("us") + 12 * HOUR + 1).alias("end"))
    j = intervals.point_join(p, spans, ["user_id"], "us", width=12 * HOUR, longest=12 * HOUR + 1).where("us > start or (us = start and event_id > a_id)")
    return j.select("a_id", F.col("event_id").alias("b_id"), (F.col("us") - F.col("start")).alias("apart"))


@query(f"WITH {_EV}, {_spans_sql('click', 2)}, f AS (SELECT *, CASE WHEN s - max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {HOUR} THEN 0 ELSE 1 END AS fresh FROM w), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS island FROM f) SELECT user_id, min(s) AS start, max(t) AS \"end\", count(*) AS n FROM g GROUP BY user_id, island")
def w5_islands(t):
    return intervals.islands(_spans(t, "click", 2), ["user_id"], gap=HOUR, width=_DAY)


@query(f"WITH {_EV}, m AS (SELECT user_id, floor(us / {24 * HOUR}) AS day, count(*) AS c FROM e GROUP BY ALL), x AS (SELECT user_id, CAST(day AS BIGINT) AS start, CAST(day AS BIGINT) + 1 AS \"end\", c > 1 AS busy FROM m), f AS (SELECT *, CASE WHEN lag(\"end\") OVER o = start AND lag(busy) OVER o = busy THEN 0 ELSE 1 END AS fresh FROM x WINDOW o AS (PARTITION BY user_id ORDER BY start)), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY start) AS run FROM f) SELECT user_id, busy, min(start) AS start, max(\"end\") AS \"end\", count(*) AS n FROM g GROUP BY user_id, busy, run")
def w6_coalesce_equal(t):
    days_ = _events(t).groupBy("user_id", F.floor(F.col("us") / (24 * HOUR)).alias("start")).agg((F.count(F.lit(1)) > 1).alias("busy"))
    return intervals.coalesce_equal(days_.withColumn("end", F.col("start") + 1), ["user_id"], ["busy"], width=30)


@query(f"WITH {_EV}, {_spans_sql('error', 1)}, f AS (SELECT w_id, s, t, lag(t) OVER o AS p, lead(s) OVER o AS q FROM w WINDOW o AS (PARTITION BY user_id ORDER BY s, t)) SELECT w_id, least(s, greatest(s - {24 * HOUR}, coalesce(p, s - {24 * HOUR}))) AS left_start, greatest(t, least(t + {24 * HOUR}, coalesce(q, t + {24 * HOUR}))) AS right_end FROM f")
def w7_neighbour_clipping(t):
    return intervals.flanks(_spans(t, "error"), ["user_id"], 24 * HOUR, width=_DAY).select("w_id", "left_start", "right_end")


@query(f"WITH {_EV}, {_spans_sql('signup', 1)}, f AS (SELECT user_id, t AS gap_start, lead(s) OVER (PARTITION BY user_id ORDER BY s, t) AS gap_end FROM w) SELECT user_id, count(*) AS gaps, CAST(sum(gap_end - gap_start) AS BIGINT) AS total FROM f WHERE gap_end > gap_start GROUP BY user_id")
def w8_gaps(t):
    g = intervals.gaps(_spans(t, "signup"), ["user_id"], width=_DAY)
    return g.groupBy("user_id").agg(F.count(F.lit(1)).alias("gaps"), F.sum(F.col("gap_end") - F.col("gap_start")).alias("total"))


_CUTS = f"WITH {_EV}, {_spans_sql('view', 24)}, c AS (SELECT user_id, s AS cut FROM w UNION SELECT user_id, t FROM w), p AS (SELECT user_id, cut AS start, lead(cut) OVER (PARTITION BY user_id ORDER BY cut) AS \"end\" FROM c)"


@query(_CUTS + " SELECT user_id, start, \"end\" FROM p WHERE \"end\" IS NOT NULL")
def w16_elementary_intervals(t):
    return intervals.elementary(_spans(t, "view", 24), ["user_id"], width=_DAY)


@query(_CUTS + ", d AS (SELECT p.user_id, p.start, p.\"end\", (SELECT count(*) FROM w WHERE w.user_id = p.user_id AND w.s <= p.start AND w.t >= p.\"end\") AS depth FROM p WHERE \"end\" IS NOT NULL) SELECT user_id, start, \"end\", depth FROM d")
def w16_depth(t):
    return intervals.depth(_spans(t, "view", 24), ["user_id"], width=_DAY).withColumn("depth", F.col("depth").cast("long"))


@query(f"WITH {_EV}, {_spans_sql('purchase', 5)} SELECT w_id, k AS tile, s + k * {2 * HOUR} AS tile_start, least(t, s + (k + 1) * {2 * HOUR}) AS tile_end FROM w, unnest(range(0, 3)) AS u(k)")
def w16_tiles(t):
    return intervals.tiles(_spans(t, "purchase", 5), 2 * HOUR).select("w_id", "tile", "tile_start", "tile_end")


@query("WITH k AS (SELECT doc_id, n_chars, unnest(range(0, CAST(greatest(0, ceil((n_chars - 500) / 400.0)) AS BIGINT) + 1)) AS chunk FROM documents WHERE n_chars > 0) SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, chunk * 400 AS chunk_start, least(n_chars, chunk * 400 + 500) AS chunk_end FROM k")
def w17_overlapping_chunks(t):
    return intervals.chunks(t.documents, "n_chars", 500, 100).select("doc_id", "chunk", F.col("chunk_start").cast("long"), "chunk_end")


@query(f"WITH RECURSIVE {_EV}, {_spans_sql('click', 12)}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s, t, w_id) AS k FROM w), f AS (SELECT user_id, k, w_id, true AS kept, t AS last FROM r WHERE k = 1 UNION ALL SELECT r.user_id, r.k, r.w_id, r.s >= f.last, CASE WHEN r.s >= f.last THEN r.t ELSE f.last END FROM f JOIN r ON r.user_id = f.user_id AND r.k = f.k + 1) SELECT w_id, kept FROM f")
def w11_greedy_non_overlap(t):
    return intervals.greedy(_spans(t, "click", 12), ["user_id"], "w_id", width=_DAY).select("w_id", "kept")


@query(f"WITH {_EV}, {_spans_sql('purchase', 6, 'a')}, {_spans_sql('view', 6, 'b')}, j AS (SELECT a.w_id, b.w_value AS v, least(a.t, b.t) - greatest(a.s, b.s) AS n FROM a JOIN b ON a.user_id = b.user_id AND a.t > b.s AND a.s < b.t) SELECT w_id, round(sum(v * n) / sum(n), 6) AS weighted_mean, CAST(sum(n) AS BIGINT) AS covered FROM j WHERE n >= {HOUR} GROUP BY w_id")
def a9_overlap_weighted_mean(t):
    out = intervals.weighted_by_overlap(_spans(t, "purchase", 6), _spans(t, "view", 6), ["user_id"], "w_value", ["w_id"], HOUR, 6 * HOUR)
    return out.withColumn("weighted_mean", F.round("weighted_mean", 6))


_TREE = "tree AS (SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region)"
_CLOSE = "clo AS (SELECT node AS descendant, parent AS ancestor, 1 AS depth FROM tree UNION ALL SELECT clo.descendant, tree.parent, clo.depth + 1 FROM clo JOIN tree ON tree.node = clo.ancestor)"


def _tree(t):
    a = t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"))
    return a.union(t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")), F.lit("world")))


@query(f"WITH RECURSIVE {_TREE}, {_CLOSE}, n AS (SELECT node FROM tree UNION SELECT parent FROM tree) SELECT ancestor, descendant, depth FROM clo UNION ALL SELECT node, node, 0 FROM n")
def j13_hierarchy_closure(t):
    return hierarchy.closure(_tree(t))


@query(f"WITH {_TREE}, c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT node, parent, coalesce(CASE WHEN node[1] = 'n' THEN (SELECT n FROM c WHERE 'n' || c_nationkey = node) ELSE (SELECT sum(n) FROM c JOIN nation ON n_nationkey = c_nationkey WHERE 'r' || n_regionkey = node) END, 0)::DOUBLE AS share FROM tree) SELECT s.node, s.share - coalesce((SELECT sum(k.share) FROM s k WHERE k.parent = s.node), 0) AS exclusive, s.share - coalesce((SELECT sum(k.share) FROM s k WHERE k.parent = s.node), 0) >= -1e-9 AS ok FROM s")
def d1_exclusive_fraction(t):
    per = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    counts = per.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("k")).count().union(per.groupBy(F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))).count())
    nodes = _tree(t).join(counts, F.col("node") == F.col("k"), "left").select("node", "parent", F.coalesce("count", F.lit(0)).cast("double").alias("share"))
    return hierarchy.exclusive(nodes)


# The flagship: sites are orders, records are shipments of the same customer with the
# supplier's nation as source; a record carries the site's variant if its nation lies
# under the site's region and the line was returned.
_D31 = f"""
WITH RECURSIVE {_TREE}, {_CLOSE},
under AS (SELECT ancestor, descendant FROM clo UNION ALL SELECT node, node FROM tree),
site AS (SELECT o_orderkey AS site, o_custkey AS cust, datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS pos, o_orderpriority AS tier, 'r' || n_regionkey AS clone
         FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
rec AS (SELECT o_custkey AS cust, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, 'n' || s_nationkey AS source, l_returnflag AS flag, l_quantity AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey),
share AS (SELECT 'r' || n_regionkey AS clone, count(*) / (SELECT count(*) FROM supplier)::DOUBLE / 3 AS e FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1),
per AS (SELECT site, tier, site.clone, sum(n) AS total, sum(CASE WHEN flag = 'R' AND under.descendant IS NOT NULL THEN n ELSE 0 END) AS alt
        FROM site JOIN rec ON site.cust = rec.cust AND pos >= s AND pos < s + 90 LEFT JOIN under ON under.ancestor = site.clone AND under.descendant = rec.source
        GROUP BY site, tier, site.clone),
pool AS (SELECT tier, count(*) AS n_sites, sum(total) AS total, sum(alt) AS alt, sum(alt) / sum(total) AS observed, sum(e * total) / sum(total) AS expected FROM per JOIN share USING (clone) GROUP BY tier),
z AS (SELECT *, sqrt(greatest(expected * (1 - expected) / total, 1e-12)) / expected AS sigma, abs(observed - expected) / expected AS deviation FROM pool)
"""


def truth_fraction(t):
    closed = sets.small(hierarchy.closure(_tree(t)).select("ancestor", "descendant"))
    region = F.broadcast(t.nation.select("n_nationkey", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("clone")))
    site = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(region, F.col("c_nationkey") == F.col("n_nationkey"))
    site = site.select(F.col("o_orderkey").alias("site"), F.col("o_custkey").alias("cust"), days("o_orderdate").alias("pos"), F.col("o_orderpriority").alias("tier"), "clone")
    rec = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    rec = rec.select(F.col("o_custkey").alias("cust"), days("l_shipdate").alias("start"), (days("l_shipdate") + 90).alias("end"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("record"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("n"))
    hit = intervals.point_join(site, rec, ["cust"], width=90, longest=90).join(closed, (F.col("clone") == F.col("ancestor")) & (F.col("record") == F.col("descendant")), "left")
    carried = F.when((F.col("flag") == "R") & F.col("descendant").isNotNull(), F.col("n")).otherwise(0.0)
    per = hit.groupBy("site", "tier", "clone").agg(F.sum("n").alias("total"), F.sum(carried).alias("alt"))
    by_region = t.supplier.join(region, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("clone").count()
    share = by_region.crossJoin(t.supplier.agg(F.count(F.lit(1)).alias("all"))).select("clone", (F.col("count") / F.col("all") / 3).alias("e"))  # one row joined on
    pool = per.join(F.broadcast(share), "clone").groupBy("tier").agg(F.count(F.lit(1)).alias("n_sites"), F.sum("total").alias("total"), F.sum("alt").alias("alt"), (F.sum("alt") / F.sum("total")).alias("observed"), (F.sum(F.col("e") * F.col("total")) / F.sum("total")).alias("expected"))
    e = F.col("expected")
    return pool.withColumn("sigma", F.sqrt(F.greatest(e * (1 - e) / F.col("total"), F.lit(1e-12))) / e).withColumn("deviation", F.abs(F.col("observed") - e) / e)


@query(_D31 + "SELECT tier, n_sites, total, alt, round(observed, 9) AS observed, round(expected, 9) AS expected, round(sigma, 9) AS sigma, round(deviation, 9) AS deviation, CASE WHEN deviation <= greatest(3 * sigma, 0.10) THEN 'PASS' ELSE 'FAIL (deviates)' END AS verdict FROM z")
def d31_truth_fraction(t):
    out = truth_fraction(t)
    ok = F.col("deviation") <= F.greatest(3 * F.col("sigma"), F.lit(0.10))
    r = lambda c: F.round(c, 9).alias(c)
    return out.select("tier", "n_sites", "total", "alt", r("observed"), r("expected"), r("sigma"), r("deviation"), checks.verdict(ok, "deviates", F.col("total")).alias("verdict"))


@query(_D31 + "SELECT 'truth fraction' AS \"check\", tier AS file, round(deviation, 9) AS value, CASE WHEN deviation <= 0.05 THEN 'PASS' ELSE 'FAIL (out of bound)' END AS verdict FROM z")
def q27_truth_fraction_flat_bound(t):
    return checks.row(truth_fraction(t), "truth fraction", F.col("tier"), F.round("deviation", 9), checks.band(F.col("deviation"), high=0.05))
