"""Aggregates on the sales tables, events and documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from .registry import query

PART_ROWS = 500_000  # rows that one task counts


@query("SELECT 'l_returnflag' AS field, l_returnflag AS key, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY ALL UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY ALL")
def a1_frequency_tables(t):
    return agg.frequency_tables(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def a1_grouping_sets(t):
    t.lineitem.createOrReplaceTempView("quern_lineitem")
    return t.spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS level FROM quern_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1")
def a2_count_by_key(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS alt, count(*) AS total FROM lineitem GROUP BY 1")
def a3_conditional_pair(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("alt"), F.count(F.lit(1)).alias("total"))


@query("WITH p AS (SELECT l_returnflag, sum(l_quantity * l_discount) / sum(l_quantity) AS o, sum(0.05 * l_quantity) / sum(l_quantity) AS e, sum(l_quantity) AS total FROM lineitem GROUP BY 1) SELECT l_returnflag, round(o, 9) AS observed, round(e, 9) AS expected, total, round(sqrt(greatest(e * (1 - e) / total, 1e-12)) / e, 9) AS sigma, round(abs(o - e) / e, 9) AS deviation, round(greatest(3 * sqrt(greatest(e * (1 - e) / total, 1e-12)) / e, 0.10), 9) AS bound FROM p")
def a4_pooled_ratio(t):
    d = t.lineitem.select("l_returnflag", (F.col("l_quantity") * F.col("l_discount")).alias("part"), F.col("l_quantity").alias("total"), F.lit(0.05).alias("e"))
    out = agg.pooled_ratio(d, ["l_returnflag"], "part", "total", "e")
    return out.select("l_returnflag", *[F.round(c, 9).alias(c) if c != "total" else F.col(c) for c in ("observed", "expected", "total", "sigma", "deviation", "bound")])


@query("SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_pop(o_totalprice) / avg(o_totalprice), 9) AS relative_sd, round(greatest(3 * stddev_pop(o_totalprice) / avg(o_totalprice) / sqrt(count(*)), 0.10), 9) AS bound FROM orders GROUP BY 1 HAVING count(*) >= 20")
def a5_tier_mean_with_bound(t):
    m, s, n = F.avg("o_totalprice"), F.stddev_pop("o_totalprice"), F.count(F.lit(1))
    out = t.orders.groupBy("o_orderpriority").agg(n.alias("n"), F.round(m, 6).alias("mean"), F.round(s / m, 9).alias("relative_sd"), F.round(F.greatest(3 * s / m / F.sqrt(n), F.lit(0.10)), 9).alias("bound"))
    return out.where("n >= 20")


_RANK = "r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)"


@query(f"WITH {_RANK} SELECT lang, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.1) AS BIGINT)) THEN n_chars END) AS p10, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.5) AS BIGINT)) THEN n_chars END) AS p50, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.9) AS BIGINT)) THEN n_chars END) AS p90 FROM r GROUP BY lang")
def a6_nearest_rank_percentiles(t):
    return agg.nearest_rank_large(t.documents, ["lang"], "n_chars", [0.1, 0.5, 0.9])


@query("SELECT lang, round(avg(n_chars), 6) AS mean, round(stddev_pop(n_chars), 6) AS sd FROM documents GROUP BY 1")
def a6_mean_and_population_sd(t):
    return t.documents.groupBy("lang").agg(F.round(F.avg("n_chars"), 6).alias("mean"), F.round(F.stddev_pop("n_chars"), 6).alias("sd"))


@query("WITH m AS (SELECT o_orderpriority, median(o_totalprice) AS med FROM orders GROUP BY 1) SELECT o_orderpriority, round(med, 6) AS med, coalesce(med >= lag(med) OVER (ORDER BY o_orderpriority), true) AS rises FROM m")
def a7_median_and_monotonicity(t):
    m = t.orders.groupBy("o_orderpriority").agg(F.median("o_totalprice").alias("m"))
    before = F.lag("m").over(Window.orderBy("o_orderpriority"))  # one row a tier
    return m.select("o_orderpriority", F.round("m", 6).alias("med"), F.coalesce(F.col("m") >= before, F.lit(True)).alias("rises"))


@query("SELECT round(corr(log10(l_quantity), log10(l_extendedprice)), 9) AS r, count(*) AS n FROM lineitem WHERE l_quantity > 0 AND l_extendedprice > 0")
def a8_log_correlation(t):
    d = t.lineitem.where("l_quantity > 0 and l_extendedprice > 0")
    return d.agg(F.round(F.corr(F.log10("l_quantity"), F.log10("l_extendedprice")), 9).alias("r"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_partkey, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def a10_arg_min_with_payload(t):
    return agg.arg_best(t.lineitem, ["l_suppkey"], [F.col(c) for c in ("l_extendedprice", "l_partkey", "l_orderkey", "l_linenumber")], ["l_partkey", "l_extendedprice"])


@query("SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY (p_type = 'PROMO') DESC, (p_size >= 25) DESC, p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1")
def a11_arg_max_composite(t):
    order = [(F.col("p_type") != "PROMO"), (F.col("p_size") < 25), -F.col("p_retailprice"), F.col("p_partkey")]
    return agg.arg_best(t.part, ["p_brand"], order, ["p_partkey"])


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1")
def a12_arg_max_keep_first(t):
    return agg.arg_best(t.events, ["user_id"], [-F.col("value"), F.col("event_id")], ["event_id", "value"])


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def a13_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments FROM customer GROUP BY 1")
def a14_collect_set(t):
    return t.customer.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("SELECT lang, count(*) AS records, count(*) FILTER (length(text) = 0) AS empty, count(*) FILTER (length(text) <> n_chars) AS length_differs, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(length(regexp_replace(text, '[^A-Z]', '', 'g'))) AS BIGINT) AS upper, CAST(sum(length(regexp_replace(text, '[^0-9]', '', 'g'))) AS BIGINT) AS digits, round(avg(length(text)), 6) AS mean_length FROM documents GROUP BY 1")
def a15_one_pass_text_metrics(t):
    n = F.length("text")
    count = lambda keep: F.sum(F.length(F.regexp_replace("text", f"[^{keep}]", "")))
    return t.documents.groupBy("lang").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(n == 0).alias("empty"), F.count_if(n != F.col("n_chars")).alias("length_differs"), F.sum(n).alias("chars"),
        count("A-Z").alias("upper"), count("0-9").alias("digits"), F.round(F.avg(n), 6).alias("mean_length"))


@query("SELECT c AS ch, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(text, '[A-Za-z0-9 .,\\n]', '', 'g'), '')) AS c FROM documents) WHERE c <> '' GROUP BY 1")
def a15_offending_characters(t):
    rest = F.regexp_replace("text", r"[A-Za-z0-9 .,\n]", "")
    return t.documents.select(F.explode(F.split(rest, "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


@query("WITH c AS (SELECT unnest(range(1, length(p_name) + 1)) AS pos, p_name FROM part), h AS (SELECT pos, substr(p_name, pos, 1) AS ch, count(*) AS n FROM c WHERE pos <= length(p_name) GROUP BY ALL) SELECT CAST(pos AS INTEGER) AS pos, ch, n, round(n / sum(n) OVER (PARTITION BY pos), 9) AS frequency FROM h")
def a16_position_histogram(t):
    h = t.part.select(F.posexplode(F.split("p_name", ""))).where("col <> ''").groupBy((F.col("pos") + 1).alias("pos"), F.col("col").alias("ch")).agg(F.count(F.lit(1)).alias("n"))
    return h.withColumn("frequency", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("pos")), 9))


@query("WITH c AS (SELECT p_brand, unnest(range(1, length(p_name) + 1)) AS pos, p_name FROM part), h AS (SELECT p_brand, pos, substr(p_name, pos, 1) AS ch, count(*) AS n FROM c WHERE pos <= length(p_name) GROUP BY ALL), b AS (SELECT p_brand, pos, ch, n, sum(n) OVER (PARTITION BY p_brand, pos) AS total, row_number() OVER (PARTITION BY p_brand, pos ORDER BY n DESC, ch) AS rn FROM h) SELECT p_brand, string_agg(ch, '' ORDER BY pos) AS consensus, round(min(n / total), 9) AS worst_agreement FROM b WHERE rn = 1 GROUP BY 1")
def a17_mode_consensus(t):
    h = t.part.select("p_brand", F.posexplode(F.split("p_name", ""))).where("col <> ''").groupBy("p_brand", "pos", F.col("col").alias("ch")).agg(F.count(F.lit(1)).alias("n"))
    best = h.groupBy("p_brand", "pos").agg(F.min(F.struct((-F.col("n")).alias("m"), "ch")).alias("b"), F.sum("n").alias("total"))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("pos", "b.ch"))), lambda x: x["ch"])
    return best.groupBy("p_brand").agg(F.array_join(letters, "").alias("consensus"), F.round(F.min(-F.col("b.m") / F.col("total")), 9).alias("worst_agreement"))


@query("WITH c AS (SELECT p_size, count(*) AS n FROM part GROUP BY 1) SELECT p_size, n, round(sum(n) OVER (ORDER BY p_size) / sum(n) OVER (), 9) AS cdf FROM c")
def a18_empirical_cdf(t):
    return agg.empirical_cdf(t.part, "p_size").withColumn("cdf", F.round("cdf", 9))


@query("WITH x AS (SELECT floor(value / 5) AS bin, count(*) AS x FROM events WHERE event_type = 'purchase' GROUP BY 1), y AS (SELECT floor(value / 5) AS bin, count(*) AS y FROM events WHERE event_type <> 'purchase' GROUP BY 1), j AS (SELECT bin, y, coalesce(x, 0) AS x FROM y LEFT JOIN x USING (bin)), r AS (SELECT bin, y, least(4.0, (x / sum(x) OVER ()) / (y / sum(y) OVER ())) AS raw FROM j) SELECT CAST(bin AS BIGINT) AS bin, round(raw / (sum(raw * y) OVER () / sum(y) OVER ()), 9) AS ratio FROM r")
def a19_density_ratio(t):
    b = F.floor(F.col("value") / 5)
    return agg.density_ratio(t.events.where("event_type = 'purchase'"), t.events.where("event_type <> 'purchase'"), b, 4.0).withColumn("ratio", F.round("ratio", 9))


@query("WITH b AS (SELECT p_size // 5 AS bin, count(*) AS n, sum(p_retailprice) AS s FROM part GROUP BY 1), r AS (SELECT bin, n, (s / n) / (sum(s) OVER () / sum(n) OVER ()) AS ratio FROM b) SELECT CAST(bin AS BIGINT) AS bin, n, round(ratio / (sum(ratio * n) OVER () / sum(n) OVER ()), 9) AS factor FROM r")
def a20_binned_factor(t):
    return agg.binned_factor(t.part, F.floor(F.col("p_size") / 5), "p_retailprice").withColumn("factor", F.round("factor", 9))


@query("WITH h AS (SELECT o_custkey, sum(o_totalprice) AS have FROM orders GROUP BY 1), f AS (SELECT o_custkey, CASE WHEN have = 0 THEN 0.0 WHEN c_custkey IS NULL THEN 1.0 ELSE least(1.0, c_acctbal * 100 / have) END AS factor FROM h LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey) SELECT o_orderkey, round(o_totalprice * factor, 4) AS scaled FROM orders JOIN f USING (o_custkey)")
def a21_rescale_to_budget(t):
    budget = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") * 100).alias("budget"))
    return agg.rescale_to_budget(t.orders, ["o_custkey"], "o_totalprice", budget, "budget").select("o_orderkey", F.round("scaled", 4).alias("scaled"))


@query("SELECT o_custkey, count(*) AS shards, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1")
def a22_sum_over_shards(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("shards"), F.round(F.sum("o_totalprice"), 4).alias("total"))


@query("WITH o AS (SELECT o_custkey, max(o_orderdate) AS newest_in FROM orders GROUP BY 1), s AS (SELECT o_custkey, min(l_shipdate) AS oldest_out FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) SELECT o_custkey, round((epoch(newest_in) - epoch(oldest_out)) / 3600, 6) AS lag_hours FROM o JOIN s USING (o_custkey)")
def a23_time_lag(t):
    o = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest_in"))
    s = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.min("l_shipdate").alias("oldest_out"))
    return o.join(s, "o_custkey").select("o_custkey", F.round(F.expr("timestampdiff(SECOND, oldest_out, newest_in)") / 3600.0, 6).alias("lag_hours"))


@query("SELECT l_suppkey, round(-10 * log10(avg(pow(10, -l_quantity / 10))), 6) AS mean_quality FROM lineitem GROUP BY 1")
def a24_mean_error_probability(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(-10 * F.log10(F.avg(F.pow(F.lit(10.0), -F.col("l_quantity") / 10))), 6).alias("mean_quality"))


@query("WITH g AS (SELECT o_orderkey, count(DISTINCT s_nationkey) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1) SELECT o_orderkey, n FROM g WHERE n > 1")
def a26_conflicts(t):
    """Lines are dealt by order, as many parts as their number asks for, and then counted: neither
    a scanning task nor a merged part holds more pairs of order and nation than its share."""
    j = t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("o_orderkey"), "s_nationkey")
    n = j.repartition(t.lineitem.count() // PART_ROWS + 1, "o_orderkey").groupBy("o_orderkey").agg(F.countDistinct("s_nationkey").alias("n")).where("n > 1")
    return n.join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi")


@query("SELECT n_nationkey, round(count(c_custkey) / sum(count(c_custkey)) OVER (), 9) AS share FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def a27_share_of_total(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("k")).count()
    d = t.nation.select("n_nationkey").join(counts, F.col("n_nationkey") == F.col("k"), "left").withColumn("c", F.coalesce("count", F.lit(0)))
    return d.select("n_nationkey", F.round(agg.shares("c"), 9).alias("share"))


@query("WITH p AS (SELECT p_brand, p_partkey, CASE WHEN p_size % 10 <> 0 THEN p_retailprice END AS v FROM part), g AS (SELECT p_brand, coalesce(sum(v), 0) AS total, avg(v) AS mean FROM p GROUP BY 1) SELECT p_partkey, round(coalesce(v, mean, 0), 6) AS v, round(total, 4) AS brand_total FROM p JOIN g USING (p_brand)")
def a28_sum_with_group_mean_for_missing(t):
    p = t.part.select("p_brand", "p_partkey", F.when(F.col("p_size") % 10 != 0, F.col("p_retailprice")).alias("x"))
    g = p.groupBy("p_brand").agg(F.coalesce(F.sum("x"), F.lit(0.0)).alias("total"), F.avg("x").alias("mean"))
    return p.join(g, "p_brand").select("p_partkey", F.round(F.coalesce("x", "mean", F.lit(0.0)), 6).alias("v"), F.round("total", 4).alias("brand_total"))


@query("WITH f AS (SELECT l_orderkey, l_returnflag, first_value(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS first FROM lineitem) SELECT l_orderkey, count(*) FILTER (l_returnflag = first) AS same, count(*) FILTER (l_returnflag <> first) AS opposite FROM f GROUP BY 1 HAVING count(*) > 1")
def a29_majority_orientation(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    d = t.lineitem.withColumn("f", F.first("l_returnflag").over(w))
    out = d.groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == F.col("f")).alias("same"), F.count_if(F.col("l_returnflag") != F.col("f")).alias("opposite"))
    return out.where("same + opposite > 1")
