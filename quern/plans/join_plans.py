"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets, windows
from .registry import query


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def j1_hash_join(t):
    return t.lineitem.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority")


@query("SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def j2_left_join_with_default(t):
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def j7_anti_join(t):
    return t.part.join(t.lineitem.where("l_quantity > 45"), F.col("l_partkey") == F.col("p_partkey"), "left_anti").select("p_partkey")


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def j8_semi_join(t):
    return t.part.join(t.lineitem.where("l_quantity > 49"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("p_partkey")


@query("SELECT s_suppkey, coalesce(CASE WHEN r_name LIKE 'A%' THEN n_name END, r_name) AS place FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def j9_lookup_with_fallback(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = nations.where("r_name like 'A%'").select("n_nationkey", "n_name")
    regions = nations.select("n_nationkey", "r_name")
    out = sets.lookup_chain(t.supplier, [(named, "s_nationkey", "n_nationkey", "n_name"), (regions, "s_nationkey", "n_nationkey", "r_name")], "place")
    return sets.require_resolved(out, "place").select("s_suppkey", "place")


@query("WITH a AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal FROM conversations), b AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal FROM conversations WHERE turn > 0) SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.ordinal, b.ordinal) AS ordinal, a.role AS left_name, b.role AS right_name, CASE WHEN a.conv_id IS NULL THEN 'left exhausted' WHEN b.conv_id IS NULL THEN 'right exhausted' WHEN a.role IS NOT DISTINCT FROM b.role THEN 'paired' ELSE 'name differs' END AS status FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.ordinal = b.ordinal")
def j10_lockstep_join(t):
    c = t.conversations
    a, b = (windows.ordinals(d, ["turn"], ["conv_id"]) for d in (c, c.where("turn > 0")))
    out = windows.lockstep(a, b, ["conv_id"], "role")
    return out.withColumn("ordinal", F.col("ordinal").cast("long"))


@query("WITH n AS (SELECT DISTINCT p_brand AS name FROM part) SELECT a.name AS shadowed, b.name AS by FROM n a JOIN n b ON a.name <> b.name AND starts_with(b.name, a.name)")
def j12_prefix_shadowing(t):
    return sets.prefix_shadows(t.part, "p_brand").select("shadowed", "by")


_CELLS = "cells AS (SELECT s.c_mktsegment, p.o_orderpriority, f.o_orderstatus FROM (SELECT DISTINCT c_mktsegment FROM customer) s, (SELECT DISTINCT o_orderpriority FROM orders) p, (SELECT DISTINCT o_orderstatus FROM orders) f)"


@query(f"WITH {_CELLS}, have AS (SELECT c_mktsegment, o_orderpriority, o_orderstatus, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL) SELECT c_mktsegment, o_orderpriority, o_orderstatus, coalesce(n, 0) AS n FROM cells LEFT JOIN have USING (c_mktsegment, o_orderpriority, o_orderstatus)")
def j14_grid(t):
    cells = sets.grid(t.customer.select("c_mktsegment"), t.orders.select("o_orderpriority"), t.orders.select("o_orderstatus"))
    have = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment", "o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(have, ["c_mktsegment", "o_orderpriority", "o_orderstatus"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("WITH n AS (SELECT DISTINCT p_brand AS name FROM part), m AS (SELECT a.name, b.name AS longer, row_number() OVER (PARTITION BY a.name ORDER BY length(b.name) DESC, b.name) AS rn FROM n a JOIN n b ON starts_with(b.name, a.name)) SELECT name, longer FROM m WHERE rn = 1")
def j15_longest_by_prefix(t):
    names = t.part.select(F.col("p_brand").alias("longer")).distinct()
    every = names.select("longer", F.explode(F.transform(F.sequence(F.lit(1), F.length("longer")), lambda n: F.substring(F.col("longer"), F.lit(1), n))).alias("name"))
    own = names.select(F.col("longer").alias("name"))
    best = F.min(F.struct((-F.length("longer")).alias("n"), "longer")).alias("b")
    return every.join(own, "name").groupBy("name").agg(best).select("name", F.col("b.longer").alias("longer"))


@query("WITH g AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber, l_partkey) AS lines FROM lineitem GROUP BY 1), k AS (SELECT l_orderkey, lines, unnest(range(0, 3)) AS bracket FROM g) SELECT l_orderkey, CAST(bracket AS INTEGER) AS bracket, len(CASE WHEN bracket < 2 THEN lines[bracket * 2 + 1:bracket * 2 + 2] ELSE lines[5:] END) AS n FROM k WHERE bracket * 2 < len(lines)")
def j16_brackets_of_a_group(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    k = g.withColumn("bracket", F.explode(F.sequence(F.lit(0), F.lit(2)))).where(F.col("bracket") * 2 < F.size("lines"))
    n = F.when(F.col("bracket") < 2, F.size(F.slice("lines", F.col("bracket") * 2 + 1, 2))).otherwise(F.size("lines") - 4)
    return k.select("l_orderkey", "bracket", n.cast("long").alias("n"))


@query("WITH j AS (SELECT a.l_suppkey, a.l_returnflag = b.l_returnflag AS agree FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1) SELECT l_suppkey, CAST(sum(agree::INT) AS BIGINT) AS agree, CAST(sum((NOT agree)::INT) AS BIGINT) AS disagree, sum((NOT agree)::INT) > sum(agree::INT) AS flip FROM j GROUP BY 1")
def j17_majority_vote(t):
    a = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")
    b = t.lineitem.select(F.col("l_orderkey"), (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_returnflag").alias("other"))
    return sets.majority_flip(a.join(b, ["l_orderkey", "l_linenumber"]), ["l_suppkey"], F.col("l_returnflag") == F.col("other"))


@query("SELECT event_id, first_order FROM (SELECT event_id, o_orderkey AS first_order, row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate, o_orderkey) AS rn FROM events JOIN orders ON o_custkey = user_id) WHERE rn = 1")
def j19_first_hit(t):
    j = t.events.select("event_id", "user_id").join(t.orders, F.col("o_custkey") == F.col("user_id"))
    return sets.first_hit(j, ["event_id"], ["o_orderdate", "o_orderkey"]).select("event_id", F.col("o_orderkey").alias("first_order"))


@query("SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey")
def j20_dimension_lookup(t):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@query("SELECT o_orderkey, l_linenumber, l_partkey, n_regionkey = (s_suppkey % 5) AND (l_returnflag = 'A' OR l_returnflag = 'R' AND o_orderstatus = 'F') AS carries FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey")
def j18_carry_predicate(t):
    j = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    kind = (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "R") & (F.col("o_orderstatus") == "F"))
    return j.select("o_orderkey", "l_linenumber", "l_partkey", ((F.col("n_regionkey") == F.col("s_suppkey") % 5) & kind).alias("carries"))


@query("SELECT 'c' || c_custkey AS name, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT 'n' || s_nationkey, count(*) FROM supplier GROUP BY 1 HAVING count(*) > 1")
def u1_union_with_duplicate_guard(t):
    both = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name")).union(t.supplier.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))))
    return sets.duplicates(both, ["name"])


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def u2_union_all_of_shards(t):
    flags = ("A", "N", "R")
    parts = [t.lineitem.where(F.col("l_returnflag") == f) for f in flags] + [t.lineitem.where(~F.col("l_returnflag").isin(*flags))]
    return sets.union_of_keys(*parts).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def u3_intersect(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query("SELECT * FROM (SELECT k, 'left' AS side FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events) UNION ALL SELECT k, 'right' FROM (SELECT user_id AS k FROM events EXCEPT SELECT o_custkey FROM orders))")
def u4_except_both_ways(t):
    return sets.symmetric_difference(t.orders.select(F.col("o_custkey").alias("k")), t.events.select(F.col("user_id").alias("k")), "k")


@query("SELECT c_nationkey AS k FROM customer UNION SELECT n_nationkey FROM nation")
def u5_union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.nation.select("n_nationkey")).distinct()


_RUNS = "SELECT DISTINCT {k}, array_to_string(w[i:i + 4], ' ') AS r FROM (SELECT {k}, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT {k}, string_split(lower(text), ' ') AS w FROM {t}) WHERE len(w) >= 5)"


@query(f"WITH i AS ({_RUNS.format(k='item_id', t='benchmark')}), d AS ({_RUNS.format(k='doc_id', t='documents')}), n AS (SELECT item_id, count(*) AS n FROM i GROUP BY 1) SELECT item_id AS a_key, doc_id AS b_key, count(*) AS shared, round(count(*) / any_value(n), 9) AS containment FROM i JOIN d USING (r) JOIN n USING (item_id) GROUP BY ALL")
def u6_containment(t):
    """By all runs of five words of whole texts."""
    def runs(df, key):
        w = df.select(F.col(key).alias("key"), F.split(F.lower("text"), " ").alias("w")).where("size(w) >= 5")
        return w.select("key", F.explode(F.expr("transform(sequence(1, size(w) - 4), i -> array_join(slice(w, i, 5), ' '))")).alias("r"))

    out = sets.containment(runs(t.benchmark, "item_id"), runs(t.documents, "doc_id"), "key", "r")
    return out.withColumn("containment", F.round("containment", 9))


@query("SELECT 'declared' AS side, CAST(k AS VARCHAR) AS k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase') UNION ALL SELECT 'found', CAST(k AS VARCHAR) FROM (SELECT user_id AS k FROM events WHERE event_type = 'purchase' EXCEPT SELECT c_custkey FROM customer)")
def u7_completeness_guard(t):
    found = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("k"))
    out = sets.symmetric_difference(t.customer.select(F.col("c_custkey").alias("k")), found, "k")
    return out.select(F.when(F.col("side") == "left", "declared").otherwise("found").alias("side"), F.col("k").cast("string").alias("k"))
