"""Filters and derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import windows
from ._times import days
from .registry import query


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p1_equality_and_in(t):
    return t.orders.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("SELECT page_id, try_cast(regexp_extract(url, 'page=([0-9a-z]*)', 1) AS INTEGER) AS page FROM pages WHERE try_cast(regexp_extract(url, 'page=([0-9a-z]*)', 1) AS INTEGER) IS NOT NULL")
def p2_try_cast_guard(t):
    page = F.regexp_extract("url", "page=([0-9a-z]*)", 1).try_cast("int")
    return t.pages.select("page_id", page.alias("page")).where("page is not null")


@query("SELECT l_orderkey, l_linenumber, l_partkey, least(l_partkey, l_suppkey) AS low, greatest(l_partkey, l_suppkey) AS high FROM lineitem")
def p3_endpoint_swap(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.least("l_partkey", "l_suppkey").alias("low"), F.greatest("l_partkey", "l_suppkey").alias("high"))


@query("SELECT c_custkey, CASE WHEN c_nationkey > 4 THEN 'N' || c_nationkey WHEN c_acctbal >= 4000 THEN 'T_amp' WHEN c_acctbal < 0 THEN 'T_LOH' ELSE 'T_het' END AS tier FROM customer")
def p6_clonality_tiers(t):
    return t.customer.select("c_custkey", F.when(F.col("c_nationkey") > 4, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).when(F.col("c_acctbal") >= 4000, "T_amp").when(F.col("c_acctbal") < 0, "T_LOH").otherwise("T_het").alias("tier"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax = 0 THEN 'a' WHEN l_discount = 0 THEN 'b' WHEN l_quantity > 45 THEN 'c' WHEN l_returnflag = 'R' THEN 'd' WHEN l_linestatus = 'O' THEN 'e' WHEN l_linenumber = 1 THEN 'f' ELSE 'g' END AS stratum FROM lineitem")
def p7_priority_strata(t):
    rules = [("l_tax = 0", "a"), ("l_discount = 0", "b"), ("l_quantity > 45", "c"), ("l_returnflag = 'R'", "d"), ("l_linestatus = 'O'", "e"), ("l_linenumber = 1", "f")]
    case = reduce(lambda c, r: c.when(F.expr(r[0]), r[1]), rules[1:], F.when(F.expr(rules[0][0]), rules[0][1])).otherwise("g")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", case.alias("stratum"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> l_linestatus AND l_partkey <> l_suppkey AND l_returnflag = 'N' THEN 'TRA' WHEN l_linestatus = 'O' THEN 'INV' WHEN l_partkey < l_suppkey THEN 'DEL' ELSE 'DUP' END AS mechanism FROM lineitem")
def p8_mechanism(t):
    c = F.col
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when((c("l_returnflag") != c("l_linestatus")) & (c("l_partkey") != c("l_suppkey")) & (c("l_returnflag") == "N"), "TRA").when(c("l_linestatus") == "O", "INV").when(c("l_partkey") < c("l_suppkey"), "DEL").otherwise("DUP").alias("mechanism"))


@query("WITH x AS (SELECT l_orderkey, CAST(sum(greatest(0, least(l_linenumber * 10 + 9, 45) - greatest(l_linenumber * 10, 15))) AS BIGINT) AS shared, CAST(sum(9) AS BIGINT) AS total FROM lineitem GROUP BY 1) SELECT l_orderkey, shared, CASE WHEN shared >= 0.95 * total THEN 'whole_loss' WHEN shared = 0 THEN 'none' WHEN shared % 3 = 0 THEN 'in_frame' ELSE 'frameshift' END AS effect FROM x")
def p10_coding_effect(t):
    exons = F.collect_list(F.struct((F.col("l_linenumber") * 10).alias("s"), (F.col("l_linenumber") * 10 + 9).alias("e")))
    d = t.lineitem.groupBy("l_orderkey").agg(exons.alias("cds"))
    shared = F.aggregate("cds", F.lit(0).cast("long"), lambda a, x: a + sc.ordered_overlap(x["s"], x["e"], F.lit(15), F.lit(45)))
    total = F.size("cds") * 9
    effect = F.when(F.col("shared") >= 0.95 * total, "whole_loss").when(F.col("shared") == 0, "none").when(F.col("shared") % 3 == 0, "in_frame").otherwise("frameshift")
    return d.withColumn("shared", shared).select("l_orderkey", "shared", effect.alias("effect"))


@query("WITH r AS (SELECT *, CASE WHEN p_size < 10 THEN 'low' WHEN p_size < 30 THEN 'mid' ELSE 'high' END AS band, row_number() OVER (PARTITION BY p_brand, CASE WHEN p_size < 10 THEN 'low' WHEN p_size < 30 THEN 'mid' ELSE 'high' END ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) SELECT p_partkey, band, rn <= 5 AS within_quota FROM r")
def p11_quota_by_band(t):
    d = t.part.withColumn("band", sc.tier(F.col("p_size"), [10, 30], ["low", "mid", "high"]))
    d = windows.numbered(d, [F.col("p_retailprice").desc(), "p_partkey"], by=["p_brand", "band"])
    return d.select("p_partkey", "band", (F.col("rn") <= 5).alias("within_quota"))


@query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_size > 40 THEN p_name ELSE '' END, ''), nullif(CASE WHEN p_size > 20 THEN p_brand ELSE '' END, ''), p_type, 'none') AS label FROM part")
def p12_coalesce_chain(t):
    blank = lambda c, n: sc.blank_to_null(F.when(F.col("p_size") > n, F.col(c)).otherwise(""))
    return t.part.select("p_partkey", F.coalesce(blank("p_name", 40), blank("p_brand", 20), "p_type", F.lit("none")).alias("label"))


@query("SELECT o_orderkey, lower(trim(CASE o_orderkey % 4 WHEN 0 THEN ' True' WHEN 1 THEN '1' WHEN 2 THEN 'no' END)) IN ('1', 'true', 'yes') AND o_orderkey % 4 <> 3 AS yes FROM orders")
def p13_boolean_text(t):
    k = F.col("o_orderkey") % 4
    return t.orders.select("o_orderkey", sc.truth(F.when(k == 0, " True").when(k == 1, "1").when(k == 2, "no")).alias("yes"))


@query("SELECT c_custkey, regexp_matches(c_name, '^Customer#[0-9]{9}$') AS conforms FROM customer")
def p15_regex_conformance(t):
    return t.customer.select("c_custkey", F.col("c_name").rlike("^Customer#[0-9]{9}$").alias("conforms"))


@query("SELECT rule, CAST(n AS BIGINT) AS n FROM (SELECT 'quantity' AS rule, count(*) FILTER (NOT (l_quantity BETWEEN 1 AND 50)) AS n FROM lineitem UNION ALL SELECT 'discount', count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.05)) FROM lineitem UNION ALL SELECT 'flag', count(*) FILTER (NOT (l_returnflag IN ('A', 'N', 'R'))) FROM lineitem)")
def p16_row_constraints(t):
    rules = {"quantity": "l_quantity between 1 and 50", "discount": "l_discount between 0 and 0.05", "flag": "l_returnflag in ('A', 'N', 'R')"}
    counted = t.lineitem.agg(*[F.count_if(~F.expr(r)).alias(k) for k, r in rules.items()])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])).alias("x")).select("x.rule", "x.n")


@query("SELECT doc_id, w AS hit FROM documents, (VALUES ('idiot'), ('password'), ('AKIA')) v(w) WHERE contains(text, w)")
def p17_forbidden_texts(t):
    words = F.array(*[F.lit(w) for w in ("idiot", "password", "AKIA")])
    return t.documents.select("doc_id", F.explode(F.filter(words, lambda w: F.contains("text", w))).alias("hit"))


@query("SELECT event_id, CASE WHEN value >= 2 AND (event_type <> 'view' OR value <= 40) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM events")
def p18_optional_bands(t):
    high = F.when(F.col("event_type") == "view", 40.0)
    return t.events.select("event_id", F.when((F.col("value") >= 2) & (high.isNull() | (F.col("value") <= high)), "PASS").otherwise("FAIL").alias("verdict"))


@query("SELECT o_orderkey, (o_orderkey & 4) = 0 AND (o_orderkey & 2304) = 0 AS primary_, CASE WHEN (o_orderkey & 16) > 0 THEN '-' ELSE '+' END AS strand FROM orders")
def p19_flag_bits(t):
    f = F.col("o_orderkey")
    return t.orders.select("o_orderkey", ((f.bitwiseAND(4) == 0) & (f.bitwiseAND(2304) == 0)).alias("primary_"), F.when(f.bitwiseAND(16) > 0, "-").otherwise("+").alias("strand"))


@query("SELECT doc_id, substr(text, least(length(text), 5) + 1, greatest(0, least(length(text), 25) - 5)) AS part FROM documents")
def p20_clamped_slice(t):
    n = F.length("text")
    return t.documents.select("doc_id", F.substring(F.col("text"), F.least(n, F.lit(5)) + 1, F.greatest(F.lit(0), F.least(n, F.lit(25)) - 5)).alias("part"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.02 THEN l_quantity ELSE 0 END AS coverage, l_discount > 0.02 AS covered FROM lineitem")
def p21_skip_but_record(t):
    ok = F.col("l_discount") > 0.02
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(ok, F.col("l_quantity")).otherwise(0.0).alias("coverage"), ok.alias("covered"))


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """A row for each rule that a row breaks (a null outcome breaks it): the row's columns and rule."""
    broken = F.array(*[F.when(~F.coalesce(F.expr(r), F.lit(False)), F.lit(k)) for k, r in rules.items()])
    return df.withColumn("rule", F.explode(F.array_compact(broken)))


@query("SELECT o_orderkey, 'total' AS rule FROM orders WHERE NOT o_totalprice > 2000 UNION ALL SELECT o_orderkey, 'date' FROM orders WHERE NOT datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) < 11000")
def p16_violation_rows(t):
    d = t.orders.withColumn("day", days("o_orderdate"))
    return violations(d, {"total": "o_totalprice > 2000", "date": "day < 11000"}).select("o_orderkey", "rule")
