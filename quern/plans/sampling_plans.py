"""Sorts, limits and deterministic sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import sampling
from ..operators.windows import numbered
from .registry import query

_U = "(CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE)"


def _u(seed, key):
    return _U.format(seed=seed, key=key)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, o_orderkey) AS place FROM orders")
def o1_custom_domain_sort(t):
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    d = t.orders.withColumn("rank", rank)
    return numbered(d, ["rank", "o_orderkey"], "place", buckets=F.col("rank") * F.lit(1 << 40) + F.floor(F.col("o_orderkey") / 1000)).select("o_orderkey", "place")


@query("SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_name) AS place FROM customer")
def o2_multi_key_sort(t):
    w = Window.partitionBy("c_mktsegment").orderBy(F.col("c_acctbal").desc(), "c_name")
    return t.customer.select("c_custkey", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5('7:' || o_orderkey), 1, 12), o_orderkey) AS place FROM orders")
def o3_keyed_shuffle(t):
    d = t.orders.select("o_orderkey", sampling.token(7, "o_orderkey").alias("token"))
    return numbered(d, [F.substring("token", 1, 12), "o_orderkey"], "place", buckets=F.substring("token", 1, 2)).select("o_orderkey", "place")


@query("SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY abs(p_retailprice - 950), p_partkey) AS place FROM part")
def o4_distance_sort(t):
    w = Window.partitionBy("p_brand").orderBy(F.abs(F.col("p_retailprice") - 950), "p_partkey")
    return t.part.select("p_partkey", "p_brand", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def o5_top_k(t):
    return t.part.orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(10).select("p_partkey", "p_retailprice")


@query("SELECT event_id FROM events ORDER BY event_id LIMIT 50")
def o6_limit(t):
    return t.events.orderBy("event_id").limit(50).select("event_id")


@query(f"WITH p AS (SELECT p_partkey, p_size::DOUBLE AS w FROM part), c AS (SELECT p_partkey, (sum(w) OVER o - w) / sum(w) OVER () AS lo, sum(w) OVER o / sum(w) OVER () AS hi FROM p WINDOW o AS (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)), d AS (SELECT event_id, {_u(5, 'event_id')} AS u FROM events) SELECT event_id, p_partkey FROM d JOIN c ON u >= lo AND u < hi")
def o7_weighted_draws(t):
    table = t.part.select("p_partkey", F.col("p_size").cast("double").alias("w"))
    return sampling.weighted_draws(table, "p_partkey", "w", t.events.select("event_id"), "event_id", 5, buckets=F.floor(F.col("p_partkey") / 1000)).select("event_id", "p_partkey")


@query("SELECT c_mktsegment, c_custkey FROM (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY substr(md5('3:' || c_custkey), 1, 12), c_custkey) AS rn FROM customer) WHERE rn <= 25")
def o8_sample_without_replacement(t):
    return sampling.pick_n(t.customer, 3, ["c_custkey"], 25, ["c_mktsegment"]).select("c_mktsegment", "c_custkey")


@query(f"SELECT event_id FROM events WHERE {_u(9, 'event_id')} < least(1.0, value / 50)")
def o9_bernoulli_thinning(t):
    return sampling.thin(t.events, 9, ["event_id"], F.col("value") / 50).select("event_id")


@query(f"SELECT event_id, {_u(1, 'event_id')} AS u FROM events")
def o10_keyed_uniform(t):
    return t.events.select("event_id", sampling.uniform(1, "event_id").alias("u"))


@query("SELECT o_orderkey, (o_orderkey * 7919 + 2 * 104729) % 1000003 AS place FROM orders")
def o11_coprime_stride(t):
    return t.orders.select("o_orderkey", sampling.stride(F.col("o_orderkey"), 1000003, 2).alias("place"))


@query(f"SELECT event_id, CAST(1 + floor({_u(12, 'event_id')} * 512) AS BIGINT) AS channel FROM events")
def o12_channel_draw(t):
    return t.events.select("event_id", (F.lit(1) + F.floor(sampling.uniform(12, "event_id") * 512)).alias("channel"))


@query("WITH ok AS (SELECT p_brand, p_partkey FROM part WHERE p_size BETWEEN 5 AND 40 AND p_type <> 'PROMO') SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY substr(md5('13:' || p_partkey), 1, 12), p_partkey) AS rn FROM ok) WHERE rn <= 3")
def o13_sites_without_rejection(t):
    return sampling.pick_n(t.part.where("p_size between 5 and 40 and p_type <> 'PROMO'"), 13, ["p_partkey"], 3, ["p_brand"]).select("p_brand", "p_partkey")


_SIZES = """
WITH RECURSIVE g AS (SELECT c_nationkey AS k, CAST(10 + c_nationkey AS BIGINT) AS n, count(*) * 7 AS total FROM customer GROUP BY 1),
b AS (SELECT k, n, total, 0 AS i, 0.1::DOUBLE AS low, 4.0::DOUBLE AS high FROM g
      UNION ALL
      SELECT k, n, total, i + 1, CASE WHEN small THEN mid ELSE low END, CASE WHEN small THEN high ELSE mid END
      FROM (SELECT *, (low + high) / 2 AS mid, list_sum(list_transform(range(1, 4), lambda x: power(x, -(low + high) / 2))) / list_sum(list_transform(range(1, n + 1), lambda x: power(x, -(low + high) / 2))) < 0.4 AS small FROM b) WHERE i < 60),
w AS (SELECT k, n, total, unnest(range(1, n + 1)) AS rank, -(low + high) / 2 AS e FROM b WHERE i = 60),
s AS (SELECT *, CAST(greatest(1, round(total * power(rank, e) / sum(power(rank, e)) OVER (PARTITION BY k))) AS BIGINT) AS size FROM w),
o AS (SELECT *, CAST(total - sum(size) OVER (PARTITION BY k) AS BIGINT) AS off FROM s),
r AS (SELECT k, max(r) AS r, max(given) AS given FROM (SELECT o.k, r, sum(least(r, size - 1)) AS given FROM o, range(0, 200) x(r) WHERE off < 0 GROUP BY o.k, r HAVING sum(least(r, size - 1)) <= max(-off)) GROUP BY k),
f AS (SELECT o.*, r.r, r.given, count(*) FILTER (size - 1 > r.r) OVER (PARTITION BY o.k ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM o LEFT JOIN r ON r.k = o.k)
SELECT k, CAST(rank AS INTEGER) AS rank, CAST(CASE WHEN off >= 0 THEN size + off // n + CASE WHEN rank <= off % n THEN 1 ELSE 0 END ELSE size - least(r, size - 1) - CASE WHEN size - 1 > r AND ahead < -off - given THEN 1 ELSE 0 END END AS BIGINT) AS size FROM f
"""


@query(_SIZES)
def o14_power_law_sizes(t):
    """The three largest of 10 to 34 groups hold 40 % of the total."""
    d = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg((F.count(F.lit(1)) * 7).alias("total")).withColumn("n", F.col("k") + 10)
    return sampling.ranked_sizes(d, "n", "total", 0.4, 3).select("k", "rank", "size")
