"""Window-style computations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import windows
from ._times import HOUR, micros
from .registry import query


@query("SELECT p_partkey, 'r' || lpad(CAST(row_number() OVER (ORDER BY p_retailprice, p_partkey) AS VARCHAR), 9, '0') AS id FROM part")
def w1_global_numbering(t):
    d = windows.numbered(t.part, ["p_retailprice", "p_partkey"], buckets=F.floor(F.col("p_retailprice") / 10))
    return d.select("p_partkey", F.concat(F.lit("r"), F.lpad(F.col("rn").cast("string"), 9, "0")).alias("id"))


@query("SELECT p_partkey, p_type || '-' || lpad(CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS VARCHAR), 4, '0') AS id FROM part WHERE p_type IS NOT NULL")
def w2_prefix_counters(t):
    d = windows.numbered(t.part.where("p_type is not null"), ["p_partkey"], by=["p_type"])
    return d.select("p_partkey", F.concat("p_type", F.lit("-"), F.lpad(F.col("rn").cast("string"), 4, "0")).alias("id"))


@query("SELECT o_orderkey, 'L' || (1 + o_orderkey % 4) || ':' || (1101 + (o_orderkey // 4) % 78) || ':' || (1000 + (o_orderkey // 312) % 20000) || ':' || (1000 + (o_orderkey * 7) % 30000) AS name FROM orders")
def w3_mixed_radix_names(t):
    i = F.col("o_orderkey")
    digit = lambda base, by, size: (F.lit(base) + F.pmod(F.floor(i / by), F.lit(size))).cast("string")
    return t.orders.select("o_orderkey", F.concat_ws(":", F.concat(F.lit("L"), digit(1, 1, 4)), digit(1101, 4, 78), digit(1000, 312, 20000), (F.lit(1000) + F.pmod(i * 7, F.lit(30000))).cast("string")).alias("name"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS upto, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) - l_quantity AS offset_ FROM lineitem")
def w4_running_sum(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.sum("l_quantity").over(w).alias("upto"), (F.sum("l_quantity").over(w) - F.col("l_quantity")).alias("offset_"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer), f AS (SELECT c_custkey, c_mktsegment, k, row_number() OVER (ORDER BY (k > 2)::INT, c_acctbal DESC, c_custkey) AS pick FROM r) SELECT c_custkey, c_mktsegment, pick FROM f WHERE pick <= 40 OR k <= 2")
def w9_floor_then_fill(t):
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    return windows.floor_then_fill(t.customer, ["c_mktsegment"], order, 2, 40).select("c_custkey", "c_mktsegment", F.col("pick").cast("long"))


@query("SELECT user_id, event_id AS first_event, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def w10_first_wins(t):
    return windows.first_wins(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", F.col("event_id").alias("first_event"), "event_type")


@query("WITH r AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1) / count(*) OVER (PARTITION BY l_returnflag) AS turn FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() OVER (ORDER BY turn, l_returnflag) AS slot FROM r")
def w12_largest_fraction_interleave(t):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rest = ["l_quantity", "l_extendedprice"]
    return windows.interleave(t.lineitem.select(*key, *rest, "l_returnflag"), "l_returnflag", key + rest, buckets=F.floor(F.col("l_orderkey") / 1000)).select(*key, "l_returnflag", "slot")


@query("WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), e AS (SELECT c_nationkey, n * 1000 / sum(n) OVER ()::DOUBLE AS x FROM c), f AS (SELECT c_nationkey, floor(x) AS base, row_number() OVER (ORDER BY x - floor(x) DESC, c_nationkey) AS k, 1000 - sum(floor(x)) OVER () AS left_ FROM e) SELECT c_nationkey, CAST(base + CASE WHEN k <= left_ THEN 1 ELSE 0 END AS BIGINT) AS seats FROM f")
def w13_largest_remainder(t):
    c = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return windows.apportion(c, "n", 1000, ["c_nationkey"]).select("c_nationkey", "seats")


@query("WITH r AS (SELECT *, p_size <= 25 AS p, row_number() OVER (PARTITION BY p_brand, p_size <= 25 ORDER BY p_retailprice DESC, p_partkey) AS k FROM part), s AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p AND k <= 3 THEN 0 ELSE 1 END, p_retailprice DESC, p_partkey) AS pick FROM r) SELECT p_brand, p_partkey, pick FROM s WHERE pick <= 5")
def w14_prefer_subset(t):
    out = windows.prefer_subset(t.part, ["p_brand"], F.col("p_size") <= 25, [F.col("p_retailprice").desc(), F.col("p_partkey")], 5)
    return out.select("p_brand", "p_partkey", F.col("pick").cast("long"))


@query("WITH f AS (SELECT user_id, event_type, CASE WHEN lag(event_type) OVER o = event_type THEN 0 ELSE 1 END AS fresh, ts, event_id FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f), r AS (SELECT user_id, event_type, run, count(*) AS n FROM g GROUP BY ALL) SELECT user_id, max(n) AS longest, count(*) AS runs FROM r GROUP BY 1")
def w15_runs(t):
    return windows.runs_of_equal(t.events, ["user_id"], ["ts", "event_id"], "event_type").groupBy("user_id").agg(F.max("n").alias("longest"), F.count(F.lit(1)).alias("runs"))


@query("SELECT event_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 16) AS BIGINT) AS bucket FROM events")
def w18_fixed_rate_bucket(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.floor((F.row_number().over(w) - 1) / 16).alias("bucket"))


@query(f"SELECT user_id, CAST(epoch_us(ts) // {HOUR} AS BIGINT) AS hour, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def w18_tumbling_windows(t):
    return t.events.groupBy("user_id", F.floor(micros("ts") / HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT text_hash, n FROM (SELECT md5(text) AS text_hash, count(*) AS n FROM documents GROUP BY 1) WHERE n > 1")
def w19_duplicates(t):
    return t.documents.groupBy(F.md5("text").alias("text_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_quantity) AS m FROM lineitem GROUP BY ALL) SELECT l_linestatus, count(*) AS tiers, coalesce(bool_and(rises), true) AS monotone FROM (SELECT l_linestatus, m >= lag(m) OVER (PARTITION BY l_linestatus ORDER BY l_returnflag) AS rises FROM m) GROUP BY 1")
def w20_monotonic_check(t):
    m = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_quantity").alias("m"))
    d = m.withColumn("rises", F.col("m") >= F.lag("m").over(Window.partitionBy("l_linestatus").orderBy("l_returnflag")))
    return d.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("tiers"), F.coalesce(F.bool_and("rises"), F.lit(True)).alias("monotone"))
