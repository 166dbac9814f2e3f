"""Checks as queries: rows of (check, file, value, verdict)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import aggregates as agg
from ..operators import checks, intervals, sets, windows
from ._times import days, micros
from .registry import query
from .scalar_plans import _P, _dna

_NONE = "FAIL (nothing measured)"


def _v(name, file, value, verdict, body):
    """SQL of a check: a row for each row of body."""
    return f"SELECT '{name}' AS \"check\", CAST({file} AS VARCHAR) AS file, CAST({value} AS DOUBLE) AS value, {verdict} AS verdict {body}"


@query(_v("fraction by tier", "p", "round(d, 9)", "CASE WHEN d <= greatest(3 * s, 0.10) THEN 'PASS' ELSE 'FAIL (deviates)' END", "FROM (SELECT l_returnflag AS p, abs(sum(l_quantity * l_discount) / sum(l_quantity) - 0.05) / 0.05 AS d, sqrt(greatest(0.05 * 0.95 / sum(l_quantity), 1e-12)) / 0.05 AS s FROM lineitem GROUP BY 1)"))
def q1_fraction_by_tier(t):
    d = t.lineitem.select("l_returnflag", (F.col("l_quantity") * F.col("l_discount")).alias("part"), F.col("l_quantity").alias("total"), F.lit(0.05).alias("e"))
    p = agg.pooled_ratio(d, ["l_returnflag"], "part", "total", "e")
    return checks.row(p, "fraction by tier", F.col("l_returnflag"), F.round("deviation", 9), checks.verdict(F.col("deviation") <= F.col("bound"), "deviates", F.col("total")))


@query("WITH m AS (SELECT o_orderpriority AS f, avg(o_totalprice) AS m FROM orders GROUP BY 1), b AS (SELECT avg(o_totalprice) AS b FROM orders) " + _v("depth ratio", "f", "round(m / b, 9)", "CASE WHEN m / b BETWEEN 0.75 AND 1.25 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM m, b"))
def q2_ratio_to_baseline(t):
    m = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("m")).crossJoin(t.orders.agg(F.avg("o_totalprice").alias("b")))  # one row
    ratio = F.col("m") / F.col("b")
    return checks.row(m, "depth ratio", F.col("o_orderpriority"), F.round(ratio, 9), checks.band(ratio, 0.75, 1.25))


@query("WITH x AS (SELECT avg(l_quantity) FILTER (l_returnflag = 'A') AS a, avg(l_quantity) FILTER (l_returnflag = 'N') AS n FROM lineitem) " + _v("normal depth", "''", "round(n / a, 9)", "CASE WHEN abs(n / a - 1) <= 0.12 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM x"))
def q3_calibrated_depth(t):
    avg = lambda f: F.avg(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    x = t.lineitem.agg((avg("N") / avg("A")).alias("r"))
    return checks.row(x, "normal depth", "", F.round("r", 9), checks.band(F.col("r"), 0.88, 1.12))


@query("WITH n AS (SELECT CASE WHEN c_custkey % 50 = 7 THEN 'x_hap1:' ELSE '' END || replace(c_name, '1', '2') AS name FROM customer), c AS (SELECT count(*) AS n, count(DISTINCT name) AS d, count(*) FILTER (regexp_matches(name, 'chr|hap|NORMAL|_T_|_A1?_|_B_')) AS l FROM n) " + _v("read names unique", "''", "n - d", "CASE WHEN n = d THEN 'PASS' ELSE 'FAIL (duplicates)' END", "FROM c") + " UNION ALL " + _v("read names carry no truth", "''", "l", "CASE WHEN l = 0 THEN 'PASS' ELSE 'FAIL (source information)' END", "FROM c"))
def q4_names_unique(t):
    name = F.concat(F.when(F.col("c_custkey") % 50 == 7, "x_hap1:").otherwise(""), F.replace("c_name", F.lit("1"), F.lit("2")))
    return checks.read_names(t.customer.select(name.alias("name")), "name")


@query(_v("unresolved", "''", "n", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (violations)' END", "FROM (SELECT count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))") + " UNION ALL " + _v("resolved share", "''", "round(s, 9)", "CASE WHEN s BETWEEN 0.35 AND 0.85 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM (SELECT avg((o_orderstatus = 'F')::INT) AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"))
def q5_every_row_resolves(t):
    lost = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    share = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).agg(F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("s"))
    return checks.report(checks.none_of(lost, "unresolved"), checks.row(share, "resolved share", "", F.round("s", 9), checks.band(F.col("s"), 0.35, 0.85)))


@query(_v("placed equals placeable", "''", "n", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (sets differ)' END", "FROM (SELECT count(*) AS n FROM ((SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer) UNION ALL (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)))"))
def q6_set_equality(t):
    return checks.set_equality(t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")), "k", "placed equals placeable")


@query(_v("correlation", "''", "round(r, 9)", "CASE WHEN r >= 0.95 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM (SELECT corr(log10(l_quantity), log10(l_extendedprice)) AS r FROM lineitem)") + " UNION ALL " + _v("both sides present", "''", "round(a / b, 9)", "CASE WHEN a / b > 0.2 THEN 'PASS' ELSE 'FAIL (one side missing)' END", "FROM (SELECT least(count(*) FILTER (l_linestatus = 'O'), count(*) FILTER (l_linestatus = 'F'))::DOUBLE AS a, greatest(count(*) FILTER (l_linestatus = 'O'), count(*) FILTER (l_linestatus = 'F'))::DOUBLE AS b FROM lineitem)"))
def q7_correlation_and_presence(t):
    x = t.lineitem.agg(F.corr(F.log10("l_quantity"), F.log10("l_extendedprice")).alias("r"), F.count_if(F.col("l_linestatus") == "O").alias("o"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    part = F.try_divide(F.least("o", "f"), F.greatest("o", "f"))
    return checks.report(checks.row(x, "correlation", "", F.round("r", 9), checks.band(F.col("r"), 0.95)), checks.row(x, "both sides present", "", F.round(part, 9), checks.verdict(part > 0.2, "one side missing")))


@query("SELECT count(*) AS checks, count(*) FILTER (bad) AS failed, CASE WHEN count(*) = 0 THEN 2 WHEN count(*) FILTER (bad) > 0 THEN 1 ELSE 0 END AS status FROM (SELECT avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders) NOT BETWEEN 0.75 AND 1.25 AS bad FROM orders GROUP BY o_orderpriority)")
def q8_status_of_a_run(t):
    return checks.failures(q2_ratio_to_baseline(t))


_RANK = "CASE WHEN rank <= 0.5 THEN 'strong' WHEN rank <= 2 THEN 'weak' ELSE 'non' END"
_CATALOG = f"""{_P}, c AS (SELECT p_partkey AS id, substr(dna, 21, 1) AS want_ref, CASE WHEN p_partkey % 97 = 0 THEN 'N' ELSE substr(dna, 21, 1) END AS ref, 'AC' AS alt,
  substr(dna, 1, 20) || CASE WHEN p_partkey % 89 = 0 THEN 'T' ELSE 'AC' END || substr(dna, 22, 20) AS mut, substr(dna, 1, 41) AS wt, p_size / 48.0::DOUBLE AS vaf, CAST(p_size // 18 AS INTEGER) AS step,
  p_size / 10.0::DOUBLE AS rank, CASE WHEN p_size % 9 = 0 THEN '' ELSE substr(p_name, 1, 5) END AS pep, CASE WHEN p_partkey % 70 = 0 THEN substr(p_name, 1, 5) ELSE substr(p_name, 2, 4) || '#' END AS wt_pep,
  CASE p_partkey % 3 WHEN 0 THEN 'frameshift' WHEN 1 THEN 'stop_loss' ELSE 'inframe_insertion' END AS consequence FROM p),
e AS (SELECT *, CASE WHEN id % 50 = 0 THEN 'weak' ELSE {_RANK} END AS tier FROM c),
m AS (SELECT step, median(vaf) AS m, lag(median(vaf)) OVER (ORDER BY step) AS before FROM e GROUP BY step),
s AS (SELECT consequence, count(*) AS n, avg((pep <> '')::INT) AS share FROM e GROUP BY 1)"""
_RULES = {
    "1 reference": "count(*) FILTER (ref <> want_ref)", "2 window": "count(*) FILTER (substr(mut, 21, length(alt)) <> alt)", "3 length": "count(*) FILTER (length(mut) <> length(wt) + length(alt) - length(ref))",
    "4 fraction": "count(*) FILTER (vaf < 0 OR vaf > 1)", "6 peptide": "count(*) FILTER ((tier IN ('strong', 'weak', 'non') AND pep = '') OR (tier = 'na' AND pep <> ''))",
    "7 tier": f"count(*) FILTER (tier <> {_RANK})", "9 counterpart": "count(*) FILTER (pep <> '' AND wt_pep <> '' AND (wt_pep = pep OR length(wt_pep) <> length(pep)))",
}


@query(f"WITH {_CATALOG}, r AS ({' UNION ALL '.join(f'SELECT {chr(39)}{k}{chr(39)} AS r, {v} AS n FROM e' for k, v in _RULES.items())} UNION ALL SELECT '5 ladder', count(*) FILTER (m > before) FROM m UNION ALL SELECT '8 share', count(*) FILTER (n >= 10 AND share < CASE consequence WHEN 'stop_loss' THEN 0.5 ELSE 0.95 END) FROM s) SELECT 'rule ' || r AS \"check\", '' AS file, CAST(n AS DOUBLE) AS value, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (violations)' END AS verdict FROM r")
def q9_self_consistency(t):
    """Nine rules on rows of a catalog, most in one pass; the ladder and the shares on groups."""
    k, s = F.col("p_partkey"), F.col("p_size")
    cut = lambda c, i, n: F.substring(c, i, n)
    d = _dna(t).select(
        k.alias("id"), cut("dna", 21, 1).alias("want_ref"), F.when(k % 97 == 0, "N").otherwise(cut("dna", 21, 1)).alias("ref"), F.lit("AC").alias("alt"),
        F.concat(cut("dna", 1, 20), F.when(k % 89 == 0, "T").otherwise("AC"), cut("dna", 22, 20)).alias("mut"), cut("dna", 1, 41).alias("wt"), (s / 48.0).alias("vaf"), F.floor(s / 18).alias("step"),
        (s / 10.0).alias("rank"), F.when(s % 9 == 0, "").otherwise(cut("p_name", 1, 5)).alias("pep"), F.when(k % 70 == 0, cut("p_name", 1, 5)).otherwise(F.concat(cut("p_name", 2, 4), F.lit("#"))).alias("wt_pep"),
        F.element_at(F.array(F.lit("frameshift"), F.lit("stop_loss"), F.lit("inframe_insertion")), (k % 3 + 1).cast("int")).alias("consequence"))
    by_rank = sc.tier(F.col("rank"), [0.5, 2], ["strong", "weak", "non"], inclusive=True)
    d = d.withColumn("tier", F.when(F.col("id") % 50 == 0, "weak").otherwise(by_rank))
    c = F.col
    bad = {
        "1 reference": c("ref") != c("want_ref"), "2 window": F.substring(c("mut"), F.lit(21), F.length("alt")) != c("alt"), "3 length": F.length("mut") != F.length("wt") + F.length("alt") - F.length("ref"),
        "4 fraction": ~c("vaf").between(0, 1), "6 peptide": (c("tier").isin("strong", "weak", "non") & (c("pep") == "")) | ((c("tier") == "na") & (c("pep") != "")),
        "7 tier": c("tier") != by_rank, "9 counterpart": (c("pep") != "") & (c("wt_pep") != "") & ((c("wt_pep") == c("pep")) | (F.length("wt_pep") != F.length("pep"))),
    }
    x = d.agg(*[F.count_if(v).alias(name) for name, v in bad.items()])
    steps = d.groupBy("step").agg(F.median("vaf").alias("m"))  # a row a step of the ladder
    ladder = steps.withColumn("before", F.lag("m").over(Window.orderBy("step"))).agg(F.count_if(c("m") > c("before")).alias("n"))
    share = d.groupBy("consequence").agg(F.count(F.lit(1)).alias("n"), F.avg((c("pep") != "").cast("int")).alias("share"))
    share = share.agg(F.count_if((c("n") >= 10) & (c("share") < F.when(c("consequence") == "stop_loss", 0.5).otherwise(0.95))).alias("n"))
    one = lambda df, name, value: checks.row(df, f"rule {name}", "", value, checks.verdict(value == 0, "violations"))
    return checks.report(*[one(x, name, F.col(f"`{name}`")) for name in bad], one(ladder, "5 ladder", F.col("n")), one(share, "8 share", F.col("n")))


@query("WITH s AS (SELECT l_orderkey, l_linenumber * 10 AS s, l_linenumber * 10 + 8 AS e FROM lineitem) " + _v("straddles", "''", "n", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (violations)' END", "FROM (SELECT count(*) AS n FROM s JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 80 > s AND o_custkey % 80 < e)"))
def q10_no_window_straddles(t):
    spans = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * 10 + 1).alias("start"), (F.col("l_linenumber") * 10 + 8).alias("end"))
    cuts = t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 80).alias("pos"))
    return checks.none_of(intervals.point_join(cuts, spans, ["k"], width=20), "straddles")


@query("WITH m AS (SELECT lang, avg(n_chars) AS m FROM documents GROUP BY 1) " + _v("length target", "lang", "round(m, 6)", "CASE WHEN m BETWEEN 1500 AND 3000 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM m"))
def q11_length_targets(t):
    m = t.documents.groupBy("lang").agg(F.avg("n_chars").alias("m"))
    return checks.row(m, "length target", F.col("lang"), F.round("m", 6), checks.band(F.col("m"), 1500, 3000))


@query("WITH x AS (SELECT l_suppkey AS file, count(*) AS n, count(*) FILTER (l_orderkey % 2999 = 0) AS leaky, count(*) FILTER (l_partkey % 997 = 0) AS other FROM lineitem GROUP BY 1), m AS (SELECT s_suppkey AS file, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) + (s_suppkey % 5 = 0)::INT AS rows FROM supplier WHERE s_suppkey % 7 <> 0), j AS (SELECT x.*, m.rows FROM x LEFT JOIN m USING (file)) " + _v("no simulator truth", "file", "leaky", "CASE WHEN leaky = 0 THEN 'PASS' ELSE 'FAIL (leaks)' END", "FROM j") + " UNION ALL " + _v("measured layout", "file", "other", "CASE WHEN other = 0 THEN 'PASS' ELSE 'FAIL (other layout)' END", "FROM j") + " UNION ALL " + _v("read map current", "file", "rows - n", "CASE WHEN rows IS NULL THEN 'FAIL (absent)' WHEN rows = n THEN 'PASS' ELSE 'FAIL (map does not describe these reads)' END", "FROM j"))
def q12_header_leaks(t):
    run, read = F.concat(F.lit("runid="), F.col("l_partkey").cast("string")), F.concat(F.lit("read="), F.col("l_orderkey").cast("string"))
    header = F.concat_ws(" ", F.lit("@id"), F.when(F.col("l_partkey") % 997 == 0, read).otherwise(run), F.when(F.col("l_partkey") % 997 == 0, run).otherwise(read), F.when(F.col("l_orderkey") % 2999 == 0, "error-free_length 9"))
    reads = t.lineitem.select(F.col("l_suppkey").alias("file"), header.alias("header"))
    n = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    maps = t.supplier.where("s_suppkey % 7 <> 0").join(n, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(F.col("s_suppkey").alias("file"), (F.coalesce("n", F.lit(0)) + (F.col("s_suppkey") % 5 == 0).cast("int")).alias("rows"))
    return checks.header_layout(reads, maps, ["runid", "read"], "error-free_length")


@query(_v("map row count", "''", "a - b", "CASE WHEN a + b = 0 THEN '" + _NONE + "' WHEN a = b THEN 'PASS' ELSE 'FAIL (counts differ)' END", "FROM (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS b)"))
def q13_map_row_counts(t):
    return checks.equal_counts(t.orders, t.lineitem.select("l_orderkey").distinct(), "map row count")


@query("WITH f AS (SELECT CAST(s_suppkey AS VARCHAR) AS file, substr(md5('g' || s_suppkey), 1, CAST(7 + (s_suppkey % 5 <> 0)::INT AS BIGINT)) AS id, s_suppkey % 7 <> 0 AS unit, s_suppkey % 11 <> 0 AS model, s_suppkey % 200 * 3 AS bytes FROM supplier), r AS (SELECT CAST(l_suppkey AS VARCHAR) AS file, l_orderkey % 997 <> 0 AS named, CASE WHEN l_suppkey % 9 = 0 THEN l_linenumber % 2 ELSE l_linenumber END AS np, l_suppkey % 13 <> 0 AS ec FROM lineitem), x AS (SELECT file, count(*) FILTER (NOT named) AS bad, count(DISTINCT np) AS np, (count(*) FILTER (ec) = 0)::INT AS lacking FROM r GROUP BY 1) "
    + " UNION ALL ".join(_v(name, "file", f"({ok})::INT", f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL (not met)' END", "FROM f") for name, ok in (("rg_id_is_8_hex", "length(id) = 8"), ("rg_pu_is_movie", "unit"), ("rg_pm_is_instrument", "model"), ("index_present", "bytes > 128")))
    + " UNION ALL " + _v("read_name", "file", "bad", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL (malformed)' END", "FROM x") + " UNION ALL " + _v("tags_present", "file", "lacking", "CASE WHEN lacking = 0 THEN 'PASS' ELSE 'FAIL (missing)' END", "FROM x") + " UNION ALL " + _v("np_varies", "file", "np", "CASE WHEN np >= 5 THEN 'PASS' ELSE 'FAIL (too few values)' END", "FROM x"))
def q14_variety(t):
    k = F.col("s_suppkey")
    id_ = F.substring(F.md5(F.concat(F.lit("g"), k.cast("string"))), F.lit(1), 7 + (k % 5 != 0).cast("int"))
    files = t.supplier.select(k.alias("file"), id_.alias("id"), F.when(k % 7 != 0, "m64").otherwise("x64").alias("unit"), F.when(k % 11 != 0, "REVIO").alias("model"), (k % 200 * 3).alias("index_bytes"))
    name = F.concat(F.lit("m64/"), F.col("l_orderkey").cast("string"), F.when(F.col("l_orderkey") % 997 != 0, "/ccs").otherwise("/x"))
    np = F.when(F.col("l_suppkey") % 9 == 0, F.col("l_linenumber") % 2).otherwise(F.col("l_linenumber")).cast("string")
    reads = t.lineitem.select(F.col("l_suppkey").alias("file"), name.alias("name"), F.create_map(F.lit("np"), np, F.lit("ec"), F.when(F.col("l_suppkey") % 13 != 0, "1.5")).alias("tags"))
    return checks.long_read_format(files, reads, ["np", "ec"])


@query("WITH x AS (SELECT l_returnflag AS f, count(*) AS n, count(*) FILTER (l_orderkey % 500 = 0) AS bad, count(DISTINCT (l_quantity, l_discount, l_tax)) AS d FROM lineitem GROUP BY 1) " + _v("read_name", "f", "bad", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL (malformed)' END", "FROM x") + " UNION ALL " + _v("r1_quality_variety", "f", "d", "CASE WHEN d BETWEEN 1200 AND 6000 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM x"))
def q15_name_form(t):
    """Names of seven fields between colons, and as many quality texts as real ones have."""
    name = F.concat_ws(":", F.lit("A00123:45:HXX:1:1101"), F.col("l_partkey").cast("string"), F.when(F.col("l_orderkey") % 500 != 0, F.col("l_suppkey").cast("string")))
    quality = F.concat_ws("|", F.col("l_quantity").cast("string"), F.col("l_discount").cast("string"), F.col("l_tax").cast("string"))
    d = t.lineitem.select("l_returnflag", name.alias("name"), quality.alias("q"))
    x = d.groupBy("l_returnflag").agg(F.count_if(~F.col("name").rlike("^[A-Z0-9]+:[0-9]+:[A-Z0-9]+:[0-9]+:[0-9]+:[0-9]+:[0-9]+$")).alias("bad"), F.countDistinct("q").alias("d"))
    return checks.report(checks.row(x, "read_name", F.col("l_returnflag"), F.col("bad"), checks.verdict(F.col("bad") == 0, "malformed")), checks.row(x, "r1_quality_variety", F.col("l_returnflag"), F.col("d"), checks.band(F.col("d"), 1200, 6000)))


@query("WITH d AS (SELECT p_brand AS f, 'C' || substr(upper(p_name), 1, CAST(p_size % 9 AS BIGINT)) || CASE WHEN p_size % 49 = 0 THEN '' ELSE 'F' END AS trb, 'CA' || CAST(p_size AS VARCHAR) || 'F' AS tra, p_size % 48 <> 0 AS named, p_size % 4 = 0 AS linked FROM part), x AS (SELECT f, count(*) AS n, CAST(sum((trb LIKE 'C%F')::INT + (tra LIKE 'C%F')::INT) AS BIGINT) AS a, CAST(sum((length(trb) > 2 AND contains(substr(trb, 2, length(trb) - 2), 'C'))::INT) AS BIGINT) AS c, count(*) FILTER (named) AS g, count(*) FILTER (linked) AS k FROM d GROUP BY 1) " + " UNION ALL ".join(_v(name, "f", value, f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL ({why})' END", "FROM x") for name, value, ok, why in (("cdr3_anchored_C_to_F", "a", "a = 2 * n", "not all"), ("cdr3_internal_cysteine", "c", "c <= 0.06 * n", "too many"), ("clonotype_names_v_and_j", "g", "g = n", "not all"), ("antigen_linked", "k", "k >= 5", "too few"))))
def q16_anchored_and_named(t):
    size = F.col("p_size")
    trb = F.concat(F.lit("C"), F.substring(F.upper("p_name"), F.lit(1), size % 9), F.when(size % 49 == 0, "").otherwise("F"))
    gene = F.when(size % 48 != 0, "V1").otherwise("")
    d = t.part.select("p_brand", trb.alias("trb"), F.concat(F.lit("CA"), size.cast("string"), F.lit("F")).alias("tra"), gene.alias("trb_v"), F.lit("J1").alias("trb_j"), F.lit("V2").alias("tra_v"), F.lit("J2").alias("tra_j"), F.when(size % 4 == 0, "x").alias("antigen"))
    return checks.receptor_truth(d, "p_brand")


@query(f"WITH {_P}, d AS (SELECT p_size % 4 AS f, dna || CASE p_size % 4 WHEN 1 THEN 'RN' WHEN 2 THEN '*' WHEN 3 THEN 'Y*' ELSE '' END AS seq FROM p), x AS (SELECT f, CAST(sum(length(regexp_replace(seq, '[ACGTN]', '', 'g'))) AS BIGINT) AS n FROM d GROUP BY 1) " + _v("bases are ACGTN", "f", "n", "CASE f WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL (R; ambiguity codes)' WHEN 2 THEN 'FAIL (*; symbolic allele)' ELSE 'FAIL (*Y; ambiguity codes and a symbolic allele)' END", "FROM x"))
def q17_alphabet(t):
    """Every letter of every sequence, with the cause of those that are none."""
    more = F.element_at(F.array(F.lit(""), F.lit("RN"), F.lit("*"), F.lit("Y*")), (F.col("p_size") % 4 + 1).cast("int"))
    d = _dna(t).select((F.col("p_size") % 4).alias("f"), F.concat("dna", more).alias("seq"))
    return checks.alphabet(d, "f", "seq")


@query(f"WITH {_P}, d AS (SELECT p_size % 3 AS f, CASE WHEN p_size = 5 THEN dna ELSE reverse(translate(dna, 'ACGT', 'TGCA')) END AS read, substr(dna, 7, 10 + p_size) AS probe FROM p), x AS (SELECT f, count(*) FILTER (contains(read, substr(probe, 1, 20))) AS s, count(*) FILTER (NOT contains(read, substr(probe, 1, 20)) AND contains(read, reverse(translate(substr(probe, 1, 20), 'ACGT', 'TGCA')))) AS a FROM (SELECT * FROM d WHERE length(probe) >= 20 UNION ALL SELECT 9, dna, substr(dna, 1, 20) FROM p WHERE p_partkey < 20 UNION ALL SELECT 2, dna, substr(dna, 1, 20) FROM p WHERE p_size = 20) GROUP BY 1) " + _v("antisense", "f", "s", "CASE WHEN s + a < 20 THEN 'SKIP (too few)' WHEN s = 0 THEN 'PASS' ELSE 'FAIL (' || s || ' of ' || (s + a) || ' sense)' END", "FROM x"))
def q18_direction(t):
    """Reads of one kind are turned the wrong way; another has too few."""
    d = _dna(t).select((F.col("p_size") % 3).alias("f"), F.when(F.col("p_size") == 5, F.col("dna")).otherwise(F.reverse(F.translate("dna", "ACGT", "TGCA"))).alias("read"), F.substring(F.col("dna"), F.lit(7), F.col("p_size") + 10).alias("probe"))
    turned = _dna(t).select("dna", F.substring("dna", 1, 20).alias("probe"), "p_partkey", "p_size")
    few = turned.where("p_partkey < 20").select(F.lit(9).alias("f"), "dna", "probe")
    wrong = turned.where("p_size = 20").select(F.lit(2).alias("f"), "dna", "probe")
    return checks.strand_direction(d.union(few).union(wrong), "f", "read", "probe", least=20)


@query("WITH b AS (SELECT * FROM (VALUES ('click', 1.0, 60.0), ('view', 1.0, 60.0), ('ghost', 0.0, 1.0)) v(kind, low, high)), m AS (SELECT event_type, avg(value) AS m FROM events GROUP BY 1) SELECT 'bands' AS \"check\", coalesce(kind, event_type) AS file, round(m, 6) AS value, CASE WHEN kind IS NULL THEN 'FAIL (unknown kind)' WHEN m IS NULL THEN 'FAIL (missing report)' WHEN m BETWEEN low AND high THEN 'PASS' ELSE 'FAIL (out of bound)' END AS verdict FROM b FULL JOIN m ON kind = event_type")
def q19_bands_per_kind(t):
    b = t.spark.createDataFrame([("click", 1.0, 60.0), ("view", 1.0, 60.0), ("ghost", 0.0, 1.0)], "kind string, low double, high double")
    m = t.events.groupBy("event_type").agg(F.avg("value").alias("m"))
    j = b.join(m, F.col("kind") == F.col("event_type"), "full")
    v = F.when(F.col("kind").isNull(), "FAIL (unknown kind)").when(F.col("m").isNull(), "FAIL (missing report)").otherwise(checks.band(F.col("m"), F.col("low"), F.col("high")))
    return checks.row(j, "bands", F.coalesce("kind", "event_type"), F.round("m", 6), v)


@query("WITH x AS (SELECT s_suppkey AS file, s_suppkey % 6 AS k, s_suppkey % 2 = 0 AS chain FROM supplier) " + _v("consumer preflight", "file", "CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 5 THEN 0 END", "CASE k WHEN 3 THEN 'FAIL (no report)' WHEN 4 THEN 'FAIL (unreadable report)' WHEN 1 THEN 'FAIL (' || CASE WHEN chain THEN 'star at quant' ELSE 'star' END || ' rejected the data)' WHEN 2 THEN 'FAIL (' || CASE WHEN chain THEN 'star at quant' ELSE 'star' END || ' exited)' ELSE 'PASS' END", "FROM x"))
def q20_parse_errors(t):
    k = F.col("s_suppkey") % 6
    stages = F.when(F.col("s_suppkey") % 2 == 0, '[{"ok":true},{"ok":false}]').otherwise("[]")
    said = F.when(k == 1, '"parse_error":true,"ok":false,"exit_code":1').when(k == 2, '"parse_error":false,"ok":false,"exit_code":2').otherwise('"ok":true,"exit_code":0')
    text = F.when(k == 4, "{oops").otherwise(F.concat(F.lit('{"tool":"star","stage":"quant","stages":'), stages, F.lit(","), said, F.lit("}")))
    return checks.preflight(t.supplier.where(k != 3).select(F.col("s_suppkey").alias("file"), text.alias("text")), t.supplier.select(F.col("s_suppkey").alias("file")))


@query("WITH x AS (SELECT c_mktsegment AS f, count(*) / (SELECT count(*) / 5.0 FROM customer) AS y FROM customer GROUP BY 1) " + _v("yield", "f", "round(y, 9)", "CASE WHEN abs(y - 1) <= 0.15 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM x"))
def q21_yield_against_design(t):
    total = t.customer.agg((F.count(F.lit(1)) / 5.0).alias("want"))
    x = t.customer.groupBy("c_mktsegment").count().crossJoin(total).withColumn("y", F.col("count") / F.col("want"))  # one row
    return checks.row(x, "yield", F.col("c_mktsegment"), F.round("y", 9), checks.verdict(F.abs(F.col("y") - 1) <= 0.15))


@query("WITH o AS (SELECT o_orderpriority AS f, max(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))) AS newest, min(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS oldest FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) " + _v("currency", "f", "newest - oldest", "CASE WHEN newest - oldest <= 0 THEN 'PASS' ELSE 'FAIL (stale)' END", "FROM o"))
def q22_currency(t):
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(F.max(days("o_orderdate")).alias("newest"), F.min(days("l_shipdate")).alias("oldest"))
    lag = F.col("newest") - F.col("oldest")
    return checks.row(j, "currency", F.col("o_orderpriority"), lag, checks.verdict(lag <= 0, "stale"))


@query("WITH x AS (SELECT lang, count(*) FILTER (length(text) <> n_chars) AS a, count(*) FILTER (length(text) = 0) AS b, sum(length(regexp_replace(text, '[^eE]', '', 'g'))) / sum(length(text))::DOUBLE AS e FROM documents GROUP BY 1) " + " UNION ALL ".join([_v("length differs", "lang", "a", "CASE WHEN a = 0 THEN 'PASS' ELSE 'FAIL (violations)' END", "FROM x"), _v("empty", "lang", "b", "CASE WHEN b = 0 THEN 'PASS' ELSE 'FAIL (violations)' END", "FROM x"), _v("composition", "lang", "round(e, 9)", "CASE WHEN e BETWEEN 0.05 AND 0.30 THEN 'PASS' ELSE 'FAIL (out of bound)' END", "FROM x")]))
def q23_record_structure(t):
    n = F.length("text")
    x = t.documents.groupBy("lang").agg(F.count_if(n != F.col("n_chars")).alias("a"), F.count_if(n == 0).alias("b"), (F.sum(F.length(F.regexp_replace("text", "[^eE]", ""))) / F.sum(n)).alias("e"))
    zero = lambda name, c: checks.row(x, name, F.col("lang"), F.col(c), checks.verdict(F.col(c) == 0, "violations"))
    return checks.report(zero("length differs", "a"), zero("empty", "b"), checks.row(x, "composition", F.col("lang"), F.round("e", 9), checks.band(F.col("e"), 0.05, 0.30)))


@query("WITH a AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'assistant') " + _v("mates paired", "''", "n", "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (violations)' END", "FROM (SELECT count(*) AS n FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.k = b.k WHERE a.k IS NULL OR b.k IS NULL)"))
def q24_mates_paired(t):
    a, b = (windows.ordinals(t.conversations.where(F.col("role") == r), ["turn"], ["conv_id"]) for r in ("user", "assistant"))
    j = windows.lockstep(a, b, ["conv_id"], "role").where(F.col("status").isin("left exhausted", "right exhausted"))
    return checks.none_of(j, "mates paired")


@query("WITH f AS (SELECT o_orderkey AS file, n = o_orderkey % 4 + 2 AS ok, o_orderstatus <> 'P' AS indexed, epoch(o_orderdate) AS w, epoch(last) AS i FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_shipdate) - INTERVAL 60 DAY AS last FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey) " + _v("complete", "file", "coalesce(ok, false)::INT", "CASE WHEN coalesce(ok, false) THEN 'PASS' ELSE 'FAIL (truncated or malformed)' END", "FROM f") + " UNION ALL " + _v("index present and current", "file", "i - w", "CASE WHEN i IS NULL THEN 'FAIL (no index)' WHEN i < w THEN 'FAIL (stale index)' ELSE 'PASS' END", "FROM f WHERE indexed"))
def q25_complete_and_indexed(t):
    seconds = lambda c: F.floor(micros(c) / 1_000_000)
    found = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), (F.max(seconds("l_shipdate")) - 60 * 86400).alias("index_written"))
    d = t.orders.join(found, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return checks.complete_and_indexed(d.select(F.col("o_orderkey").alias("file"), (F.col("n") == F.col("o_orderkey") % 4 + 2).alias("complete"), (F.col("o_orderstatus") != "P").alias("indexed"), seconds("o_orderdate").alias("written"), "index_written"))


@query("WITH g AS (SELECT l_orderkey, l_linestatus <> first_value(l_linestatus) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS other FROM lineitem), x AS (SELECT count(*) AS n, count(*) FILTER (other) AS opposite FROM g) " + _v("orientation shared", "''", "opposite", "CASE WHEN n < 50 THEN 'SKIP (too few)' WHEN opposite = 0 THEN 'PASS' ELSE 'FAIL (opposite mates)' END", "FROM x"))
def q26_shared_orientation(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    x = t.lineitem.select((F.col("l_linestatus") != F.first("l_linestatus").over(w)).alias("o")).agg(F.count(F.lit(1)).alias("n"), F.count_if("o").alias("opposite"))
    return checks.row(x, "orientation shared", "", F.col("opposite"), F.when(F.col("n") < 50, "SKIP (too few)").otherwise(checks.verdict(F.col("opposite") == 0, "opposite mates")))


@query("WITH d AS (SELECT p_type AS f, count(*) FILTER (p_size > 10) AS reachable, count(*) FILTER (p_size > 10 AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)) AS seen FROM part GROUP BY 1) " + _v("class presence", "f", "reachable - seen", "CASE WHEN reachable = 0 THEN '" + _NONE + "' WHEN reachable = seen THEN 'PASS' ELSE 'FAIL (absent)' END", "FROM d"))
def q28_class_presence(t):
    seen = t.lineitem.select(F.col("l_partkey").alias("k")).distinct().withColumn("seen", F.lit(True))
    d = t.part.where("p_size > 10").join(seen, F.col("p_partkey") == F.col("k"), "left").groupBy("p_type").agg(F.count(F.lit(1)).alias("reachable"), F.count("seen").alias("seen"))
    d = t.part.select("p_type").distinct().join(d.withColumnRenamed("p_type", "f"), F.col("p_type").eqNullSafe(F.col("f")), "left").na.fill(0, ["reachable", "seen"])
    return checks.row(d, "class presence", F.col("p_type"), F.col("reachable") - F.col("seen"), checks.verdict(F.col("reachable") == F.col("seen"), "absent", F.col("reachable")))


@query(_v("unique after merge", "''", "n - d", "CASE WHEN n = d THEN 'PASS' ELSE 'FAIL (repeats)' END", "FROM (SELECT count(*) AS n, count(DISTINCT k) AS d FROM (SELECT 'c' || c_custkey AS k FROM customer UNION ALL SELECT 's' || s_suppkey FROM supplier))"))
def q29_unique_after_merge(t):
    both = sets.union_of_keys(t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("k")), t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("k")))
    x = both.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("k").alias("d"))
    return checks.row(x, "unique after merge", "", F.col("n") - F.col("d"), checks.verdict(F.col("n") == F.col("d"), "repeats", F.col("n")))


@query("SELECT c_custkey, CASE WHEN o.n IS NULL THEN 'missing' WHEN o.n = 0 THEN 'empty' WHEN o.bad > 0 THEN 'failed' ELSE 'passed' END AS outcome FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY 1) o ON o_custkey = c_custkey")
def q30_four_outcomes(t):
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("bad"))
    d = t.customer.join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
    return d.select("c_custkey", F.when(F.col("n").isNull(), "missing").when(F.col("n") == 0, "empty").when(F.col("bad") > 0, "failed").otherwise("passed").alias("outcome"))


@query("WITH x AS (SELECT count(*) FILTER (contains(text, 'password') OR contains(text, 'AKIA')) AS n, count(*) AS a FROM documents) " + _v("forbidden text", "''", "n", "CASE WHEN a = 0 THEN '" + _NONE + "' WHEN n = 0 THEN 'PASS' ELSE 'FAIL (hits)' END", "FROM x"))
def q32_forbidden_identifiers(t):
    hit = F.contains("text", F.lit("password")) | F.contains("text", F.lit("AKIA"))
    x = t.documents.agg(F.count_if(hit).alias("n"), F.count(F.lit(1)).alias("a"))
    return checks.row(x, "forbidden text", "", F.col("n"), checks.verdict(F.col("n") == 0, "hits", F.col("a")))


@query("SELECT 'genotype' AS \"check\", CAST(o_orderkey AS VARCHAR) AS file, CAST(o_custkey % 3 AS DOUBLE) AS value, CASE WHEN o_custkey % 3 = 2 THEN 'FAIL (not expressible)' WHEN o_orderstatus = 'P' THEN 'FAIL (not phased)' ELSE 'PASS' END AS verdict FROM orders")
def q33_genotype_expressible(t):
    k = F.col("o_custkey") % 3
    v = F.when(k == 2, "FAIL (not expressible)").when(F.col("o_orderstatus") == "P", "FAIL (not phased)").otherwise("PASS")
    return checks.row(t.orders, "genotype", F.col("o_orderkey"), k, v)


@query("WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)) AS b, (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P') AS m) " + _v("merged equals shards", "''", "a - b", "CASE WHEN a = b THEN 'PASS' ELSE 'FAIL (counts differ)' END", "FROM c") + " UNION ALL " + _v("merged equals map", "''", "a - m", "CASE WHEN a = m THEN 'PASS' ELSE 'FAIL (counts differ)' END", "FROM c"))
def q34_merge_conservation(t):
    mapped = t.lineitem.join(t.orders.where("o_orderstatus <> 'P'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return checks.conserved(t.lineitem, t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")), "n", mapped)


@query("SELECT o_orderkey, max(datediff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE))) > 0 AS held FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def q35_staging_gate(t):
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderkey").agg((F.max(days("o_orderdate") - days("l_shipdate")) > 0).alias("held"))


@query("WITH x AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'OUT_OF_MEMORY' WHEN 2 THEN 'CANCELLED by 0' WHEN 3 THEN 'TIMEOUT' WHEN 4 THEN 'COMPLETED' WHEN 5 THEN 'NODE_FAIL' ELSE 'PENDING' END AS s, CASE WHEN event_type = 'error' THEN 9 ELSE 1 END AS c FROM events), y AS (SELECT event_id, CASE WHEN s = 'CANCELLED by 0' THEN 'cancelled' WHEN s = 'FAILED' AND c = 9 THEN 'failed verdict' WHEN s = 'OUT_OF_MEMORY' THEN 'out of memory' WHEN s IN ('FAILED', 'TIMEOUT', 'NODE_FAIL') THEN 'retryable' WHEN s = 'COMPLETED' THEN 'ok' ELSE 'unknown' END AS class FROM x) SELECT event_id, class, class IN ('out of memory', 'retryable') AS retry FROM y")
def q36_failure_classes(t):
    states = F.array(*[F.lit(x) for x in ("FAILED", "OUT_OF_MEMORY", "CANCELLED by 0", "TIMEOUT", "COMPLETED", "NODE_FAIL", "PENDING")])
    state = F.element_at(states, (F.col("event_id") % 7 + 1).cast("int"))
    code = F.when(F.col("event_type") == "error", 9).otherwise(1)
    return t.events.select("event_id", checks.failure_class(state, code, 9).alias("f")).select("event_id", "f.class", "f.retry")
