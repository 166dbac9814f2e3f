"""Fits: curves and distributions that later steps look up."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import aggregates as agg
from ..operators import sets
from .registry import query


@query("WITH d AS (SELECT CAST(floor(length(regexp_replace(text, '[^aeiou]', '', 'g')) * 20 / greatest(1, length(text))) AS BIGINT) AS bin, n_chars FROM documents), b AS (SELECT bin, count(*) AS n, sum(n_chars) AS s FROM d GROUP BY 1), r AS (SELECT bin, n, (s / n::DOUBLE) / (sum(s) OVER () / sum(n) OVER ()::DOUBLE) AS ratio FROM b) SELECT bin, n, round(ratio / (sum(ratio * n) OVER () / sum(n) OVER ()), 9) AS factor FROM r")
def c1_composition_bias(t):
    vowels = F.length(F.regexp_replace("text", "[^aeiou]", ""))
    return agg.binned_factor(t.documents, F.floor(vowels * 20 / F.greatest(F.lit(1), F.length("text"))), "n_chars").withColumn("factor", F.round("factor", 9))


@query("WITH x AS (SELECT CAST(floor(log10(l_extendedprice) / 0.25) AS BIGINT) AS bin, count(*) AS x FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), y AS (SELECT CAST(floor(log10(l_extendedprice) / 0.25) AS BIGINT) AS bin, count(*) AS y FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1), j AS (SELECT bin, y, coalesce(x, 0) AS x FROM y LEFT JOIN x USING (bin)), r AS (SELECT bin, y, least(3.0, (x / sum(x) OVER ()) / (y / sum(y) OVER ())) AS raw FROM j) SELECT bin, round(raw / (sum(raw * y) OVER () / sum(y) OVER ()), 9) AS ratio FROM r")
def c2_size_selection(t):
    b = F.floor(F.log10("l_extendedprice") / 0.25)
    return agg.density_ratio(t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_returnflag <> 'R'"), b, 3.0).withColumn("ratio", F.round("ratio", 9))


@query("WITH c AS (SELECT l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_linestatus, l_linenumber, n, round(sum(n) OVER (PARTITION BY l_linestatus ORDER BY l_linenumber) / sum(n) OVER (PARTITION BY l_linestatus), 9) AS cdf FROM c")
def c3_pass_count_cdf(t):
    return agg.empirical_cdf(t.lineitem, "l_linenumber", ["l_linestatus"]).withColumn("cdf", F.round("cdf", 9))


@query("SELECT l_linestatus, count(*) AS reads, round(avg(l_linenumber), 9) AS np_mean, median(l_linenumber) AS np_median, round(median(l_quantity / l_linenumber), 9) AS ec_over_np FROM lineitem GROUP BY 1")
def c3_pass_count_summary(t):
    return agg.pass_counts(t.lineitem, ["l_linestatus"], "l_linenumber", "l_quantity").withColumn("np_mean", F.round("np_mean", 9)).withColumn("ec_over_np", F.round("ec_over_np", 9))


@query("WITH h AS (SELECT l_linenumber, l_quantity AS q, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_linenumber, q, n, round(n / sum(n) OVER (PARTITION BY l_linenumber), 9) AS frequency FROM h")
def c4_quality_by_position(t):
    h = t.lineitem.groupBy("l_linenumber", F.col("l_quantity").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    return h.withColumn("frequency", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("l_linenumber")), 9))


@query("SELECT k AS members, count(*) AS orders FROM (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY 1) GROUP BY 1")
def c5_yield_distribution(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("members")).groupBy("members").agg(F.count(F.lit(1)).alias("orders"))


@query("SELECT p_brand, min(regexp_extract(p_name, '^([a-z]+) ', 1)) AS anchor_5, max(regexp_extract(p_name, ' ([a-z]+)$', 1)) AS anchor_3 FROM part GROUP BY 1")
def c6_anchors(t):
    return t.part.groupBy("p_brand").agg(F.min(F.regexp_extract("p_name", "^([a-z]+) ", 1)).alias("anchor_5"), F.max(F.regexp_extract("p_name", " ([a-z]+)$", 1)).alias("anchor_3"))


@query("WITH d AS (SELECT lang, text, len(list_filter(regexp_extract_all(text, 'aa+|ee+|nn+|rr+|ss+|tt+|ll+|oo+|!!+'), lambda x: length(x) >= 2)) AS runs FROM documents) SELECT lang, CAST(sum(runs) AS BIGINT) AS runs, round(sum(runs) * 1000.0 / sum(length(text)), 9) AS per_thousand FROM d GROUP BY 1")
def c7_run_enrichment(t):
    runs = F.regexp_count("text", F.lit("aa+|ee+|nn+|rr+|ss+|tt+|ll+|oo+|!!+"))
    return t.documents.groupBy("lang").agg(F.sum(runs).alias("runs"), F.round(F.sum(runs) * 1000.0 / F.sum(F.length("text")), 9).alias("per_thousand"))


@query("WITH r AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS k, l_orderkey % 30 AS b FROM lineitem), s AS (SELECT l_returnflag, count(*) AS reads, sum(q + 5 + 2 + k) AS aligned, count(*) * 5 AS clipped, sum(k + 3) AS nm, count(*) * 2 AS inserted, sum(k) AS deleted, sum(q * pow(10.0, -(5 + b) / 10.0)) AS e, sum(q) AS bases FROM r GROUP BY 1) SELECT l_returnflag, reads, CAST(aligned AS BIGINT) AS aligned, round(clipped / (aligned + clipped), 9) AS clipped_fraction, CAST(nm AS BIGINT) AS nm, inserted, CAST(deleted AS BIGINT) AS deleted, round(1 - nm / aligned, 9) AS true_identity, round(1 - e / bases, 9) AS claimed_identity, round((inserted + deleted) / nm, 9) AS indel_fraction, round((nm / aligned) / (e / bases), 6) AS ratio FROM s")
def c8_claimed_and_measured(t):
    n, k = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    cigar = F.concat(F.lit("5S"), n.cast("string"), F.lit("M2I"), k.cast("string"), F.lit("D5M"))
    quality = F.repeat(F.chr(33 + 5 + F.col("l_orderkey") % 30), n)
    d = t.lineitem.select("l_returnflag", cigar.alias("cigar"), (k + 3).cast("long").alias("nm"), quality.alias("quality"))
    out = agg.alignment_identity(d, ["l_returnflag"], "cigar", "nm", "quality")
    return out.withColumns({c: F.round(c, 6 if c == "ratio" else 9) for c in ("clipped_fraction", "true_identity", "claimed_identity", "indel_fraction", "ratio")})


@query("WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events), p AS (SELECT event_type, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.05) AS BIGINT)) THEN value END) AS p5, max(CASE WHEN i = least(n - 1, CAST(floor(n * 0.95) AS BIGINT)) THEN value END) AS p95 FROM r GROUP BY 1) SELECT event_type, p5, p95, mean, sd FROM p JOIN (SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd FROM events GROUP BY 1) USING (event_type)")
def c9_length_statistics(t):
    p = agg.nearest_rank_large(t.events, ["event_type"], "value", [0.05, 0.95])
    m = t.events.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("sd"))
    return p.join(m, "event_type")


@query("WITH f AS (SELECT o_orderkey & 4095 AS flag, o_custkey AS nm FROM orders) SELECT count(*) AS records, count(*) FILTER ((flag & 4) > 0) AS unmapped, count(*) FILTER ((flag & 2304) > 0) AS secondary, count(*) FILTER ((flag & 2308) = 0) AS primary_, CAST(sum(CASE WHEN (flag & 2308) = 0 THEN nm ELSE 0 END) AS BIGINT) AS nm FROM f")
def c10_alignment_summary(t):
    f = F.col("o_orderkey").bitwiseAND(4095)
    primary = f.bitwiseAND(2308) == 0
    return t.orders.agg(F.count(F.lit(1)).alias("records"), F.count_if(f.bitwiseAND(4) > 0).alias("unmapped"), F.count_if(f.bitwiseAND(2304) > 0).alias("secondary"), F.count_if(primary).alias("primary_"), F.sum(F.when(primary, F.col("o_custkey")).otherwise(0)).alias("nm"))


@query("WITH a AS (SELECT p_partkey, p_name, md5(p_name) AS h FROM part) SELECT p_partkey, length(regexp_extract(h, '^[0-9]*')) AS lead_, CAST(list_max(list_transform(regexp_extract_all(h, '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+|a+|b+|c+|d+|e+|f+'), lambda x: length(x))) AS INTEGER) AS longest FROM a")
def w15_homopolymers(t):
    h = F.md5("p_name")
    return t.part.select("p_partkey", F.length(F.regexp_extract(h, "^[0-9]*", 0)).cast("long").alias("lead_"), sq.longest_run(h).alias("longest"))
