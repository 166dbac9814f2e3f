"""Checks as relations: (check, file, value, verdict).

Verdicts: PASS, FAIL (reason), SKIP (reason), "reported, no bound". A check that
measured nothing fails: absence is never a pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def verdict(ok: Column, reason: str | Column = "out of bound", measured: Column | None = None) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    out = F.when(ok, "PASS").otherwise(F.concat(F.lit("FAIL ("), reason, F.lit(")")))
    none = F.lit("FAIL (nothing measured)")
    return F.when(F.coalesce(measured, F.lit(0)) == 0, none).otherwise(out) if measured is not None else F.when(ok.isNull(), none).otherwise(out)


def band(value: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """PASS inside the band; either side may be open; a null value was not measured."""
    if low is None and high is None:
        return F.when(value.isNull(), "FAIL (nothing measured)").otherwise("reported, no bound")
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= low)
    if high is not None:
        ok = ok & (value <= high)
    return F.when(value.isNull(), "FAIL (nothing measured)").when(ok, "PASS").otherwise("FAIL (out of bound)")


def row(df: DataFrame, check: str, file: Column | str, value: Column, how: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), (F.lit(file) if isinstance(file, str) else file).cast("string").alias("file"), value.cast("double").alias("value"), how.alias("verdict"))


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def failures(checks: DataFrame) -> DataFrame:
    """status 0: all passed; 1: failures; 2: nothing was measured; with the counts."""
    bad = F.sum(F.when(F.col("verdict").startswith("FAIL"), 1).otherwise(0))
    n = F.count(F.lit(1))
    return checks.agg(n.alias("checks"), F.coalesce(bad, F.lit(0)).cast("long").alias("failed"), F.when(n == 0, 2).when(bad > 0, 1).otherwise(0).alias("status"))


def none_of(df: DataFrame, check: str, file: str = "") -> DataFrame:
    """PASS if df (violations) has no row, with their number as value."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return row(n, check, file, F.col("n"), verdict(F.col("n") == 0, "violations"))


def equal_counts(a: DataFrame, b: DataFrame, check: str, file: str = "") -> DataFrame:
    """Equality of row counts, never >=; two empty tables were not measured."""
    n = a.agg(F.count(F.lit(1)).alias("n")).crossJoin(b.agg(F.count(F.lit(1)).alias("m")))  # one row each
    return row(n, check, file, F.col("n") - F.col("m"), verdict(F.col("n") == F.col("m"), "counts differ", F.col("n") + F.col("m")))


def set_equality(a: DataFrame, b: DataFrame, key: str, check: str, file: str = "") -> DataFrame:
    """Both directions: keys of a that b lacks and keys of b that a lacks."""
    x, y = a.select(F.col(key).alias("k")).distinct().withColumn("x", F.lit(1)), b.select(F.col(key).alias("k")).distinct().withColumn("y", F.lit(1))
    n = x.join(y, "k", "full").agg(F.sum(F.when(F.col("x").isNull() | F.col("y").isNull(), 1).otherwise(0)).alias("n"), F.count(F.lit(1)).alias("all"))
    return row(n, check, file, F.coalesce("n", F.lit(0)), verdict(F.col("n") == 0, "sets differ", F.col("all")))


AMBIGUITY = "RYSWKMBDHV"  # fixed value: codes for several bases


def alphabet(df: DataFrame, by: Column | str, seq: str, check: str = "bases are ACGTN") -> DataFrame:
    """Of each group of sequences the number of letters other than A, C, G, T and N, with
    a verdict that names them and their cause; a group without sequences has no row.
    Letters are counted per sequence and group first: a row a letter meets the others."""
    d = df.select((F.col(by) if isinstance(by, str) else by).cast("string").alias("file"), F.explode_outer(F.filter(F.split(F.regexp_replace(seq, "[ACGTN]", ""), ""), lambda x: x != "")).alias("letter"))
    d = d.groupBy("file", "letter").agg(F.count("letter").alias("n")).groupBy("file").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("letter")), "").alias("letters"))
    codes = F.col("letters").rlike(f"[{AMBIGUITY}]")
    only = F.col("letters").rlike(f"^[{AMBIGUITY}]*$")
    cause = F.when(only, "; ambiguity codes").when(codes, "; ambiguity codes and a symbolic allele").otherwise("; symbolic allele")
    return row(d, check, F.col("file"), F.col("n"), verdict(F.col("n") == 0, F.concat("letters", cause)))


def strand_direction(df: DataFrame, by: Column | str, read: str, probe: str, check: str = "antisense", length: int = 20, least: int = 200) -> DataFrame:
    """Of each group of reads how many carry their probe (its first `length` letters) as
    it is: none may; most carry its reverse complement. Reads that carry neither, and
    probes that are shorter, say nothing; fewer than `least` that do skip the check."""
    p = F.substring(probe, 1, length)
    sense = F.contains(F.col(read), p)
    anti = ~sense & F.contains(F.col(read), F.reverse(F.translate(p, "ACGT", "TGCA")))
    d = df.where(F.length(probe) >= length).groupBy((F.col(by) if isinstance(by, str) else by).cast("string").alias("file")).agg(F.count_if(sense).alias("s"), F.count_if(anti).alias("a"))
    how = F.when(F.col("s") + F.col("a") < least, "SKIP (too few)").when(F.col("s") == 0, "PASS").otherwise(F.concat(F.lit("FAIL ("), F.col("s").cast("string"), F.lit(" of "), (F.col("s") + F.col("a")).cast("string"), F.lit(" sense)")))
    return row(d, check, F.col("file"), F.col("s"), how)


def resume_block(record: Column, code: Column, map_there: Column, recorded: Column, found: Column) -> Column:
    """Why a library cannot be resumed from, or null: no completion record, other code,
    no read map, or another number of reads, the first that holds."""
    return F.when(~F.coalesce(record, F.lit(False)), "no completion record").when(~F.coalesce(code, F.lit(False)), "other code").when(~F.coalesce(map_there, F.lit(False)), "read map is gone").when(~recorded.eqNullSafe(found), "truncated")


LEAKS = r"chr|hap|NORMAL|_T_|_A1?_|_B_"  # fixed value: what a read's name must not tell


def read_names(df: DataFrame, name: str, file: str = "") -> DataFrame:
    """Two rows: all names are unique, and none tells its source. Every name is seen."""
    x = df.groupBy(F.col(name).alias("__name")).agg(F.count(F.lit(1)).alias("__n"))
    x = x.agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("d"), F.coalesce(F.sum(F.when(F.col("__name").rlike(LEAKS), F.col("__n"))), F.lit(0)).alias("leaky"))
    unique = row(x, "read names unique", file, F.col("n") - F.col("d"), verdict(F.col("n") == F.col("d"), "duplicates", F.col("n")))
    return report(unique, row(x, "read names carry no truth", file, F.col("leaky"), verdict(F.col("leaky") == 0, "source information", F.col("n"))))


def long_read_format(files: DataFrame, reads: DataFrame, tags: Sequence[str], least: int = 5, index: int = 128) -> DataFrame:
    """Seven rows a file. files: file, id, unit, model (of its read group), index_bytes;
    reads: file, name, tags (map). The id is eight hex digits, the unit begins with m, a
    model is there, all names have the form movie/hole/ccs, every tag occurs, np has
    `least` values, the index is longer than `index` bytes. A file without reads has no
    rows about them."""
    f = files.withColumn("file", F.col("file").cast("string"))
    one = lambda check, ok: row(f, check, F.col("file"), F.coalesce(ok, F.lit(False)).cast("int"), verdict(F.coalesce(ok, F.lit(False)), "not met"))
    head = [one("rg_id_is_8_hex", F.col("id").rlike("^[0-9a-f]{8}$")), one("rg_pu_is_movie", F.col("unit").startswith("m")), one("rg_pm_is_instrument", F.col("model") != ""), one("index_present", F.col("index_bytes") > index)]
    x = reads.groupBy(F.col("file").cast("string").alias("file")).agg(
        F.count_if(~F.coalesce(F.col("name").rlike("^m[^/]*/[0-9]+/ccs"), F.lit(False))).alias("bad"), F.countDistinct(F.col("tags")["np"]).alias("np"), *[F.count(F.col("tags")[g]).alias(f"t_{g}") for g in tags])
    lacking = sum(((F.col(f"t_{g}") == 0).cast("int") for g in tags), F.lit(0))
    body = [row(x, "read_name", F.col("file"), F.col("bad"), verdict(F.col("bad") == 0, "malformed")), row(x, "tags_present", F.col("file"), lacking, verdict(lacking == 0, "missing")), row(x, "np_varies", F.col("file"), F.col("np"), verdict(F.col("np") >= least, "too few values"))]
    return report(*head, *body)


def receptor_truth(df: DataFrame, by: str, least: int = 5) -> DataFrame:
    """Four rows a file of clonotypes (two chains: trb, tra; their genes trb_v, trb_j,
    tra_v, tra_j; antigen): chains run from C to F, at most 3 % have a C inside, all
    genes are named, `least` clonotypes are linked to an antigen. A missing chain is not
    anchored; an empty gene or antigen is none."""
    there = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    each = lambda test: sum((F.coalesce(test(F.col(c)), F.lit(False)).cast("int") for c in ("trb", "tra")), F.lit(0))
    anchored = each(lambda c: c.startswith("C") & c.endswith("F"))
    inside = each(lambda c: F.contains(F.substring(c, F.lit(2), F.length(c) - 2), F.lit("C")))
    x = df.groupBy(F.col(by).cast("string").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(anchored).alias("a"), F.sum(inside).alias("c"), F.count_if(there("trb_v") & there("trb_j") & there("tra_v") & there("tra_j")).alias("g"), F.count_if(there("antigen")).alias("k"))
    one = lambda check, value, ok, why: row(x, check, F.col("file"), value, verdict(ok, why))
    return report(
        one("cdr3_anchored_C_to_F", F.col("a"), F.col("a") == 2 * F.col("n"), "not all"), one("cdr3_internal_cysteine", F.col("c"), F.col("c") <= 0.03 * 2 * F.col("n"), "too many"),
        one("clonotype_names_v_and_j", F.col("g"), F.col("g") == F.col("n"), "not all"), one("antigen_linked", F.col("k"), F.col("k") >= least, "too few"))


def conserved(merged: DataFrame, reported: DataFrame, n: str, mapped: DataFrame, file: str = "") -> DataFrame:
    """Two rows: the merged rows are as many as the shards reported in sum, and as the rows
    of the map. No rows at all were not measured."""
    c = lambda d, name: d.agg(F.count(F.lit(1)).alias(name))
    x = c(merged, "a").crossJoin(reported.agg(F.coalesce(F.sum(n), F.lit(0)).alias("b"))).crossJoin(c(mapped, "m"))  # one row each
    one = lambda check, other: row(x, check, file, F.col("a") - F.col(other), verdict(F.col("a") == F.col(other), "counts differ", F.col("a") + F.col(other)))
    return report(one("merged equals shards", "b"), one("merged equals map", "m"))


RETRYABLE = "FAILED|OUT_OF_MEMORY|TIMEOUT|NODE_FAIL|DEADLINE"  # fixed value: states of a task


def failure_class(state: Column, code: Column, verdict_code: int) -> Column:
    """class, retry of a task: ok, cancelled, failed verdict (it ran and found the data
    wanting: the reserved exit code), out of memory, retryable, or unknown. Only the last
    but one and out of memory are tried again. A null state is unknown."""
    name = F.when(state.startswith("CANCELLED"), "cancelled").when((state == "FAILED") & (code == verdict_code), "failed verdict").when(state == "OUT_OF_MEMORY", "out of memory")
    name = name.when(state.rlike(f"^({RETRYABLE})"), "retryable").when(state.startswith("COMPLETED"), "ok").otherwise("unknown")
    return F.struct(name.alias("class"), name.isin("out of memory", "retryable").alias("retry"))


def complete_and_indexed(files: DataFrame) -> DataFrame:
    """A row a file (file, complete, indexed, written, index_written): it is complete; and a
    row each that needs an index: it is there and not older than the file."""
    ok = F.coalesce(F.col("complete"), F.lit(False))
    current = F.when(F.col("index_written").isNull(), "FAIL (no index)").when(F.col("index_written") < F.col("written"), "FAIL (stale index)").otherwise("PASS")
    return report(row(files, "complete", F.col("file"), ok.cast("int"), verdict(ok, "truncated or malformed")), row(files.where("indexed"), "index present and current", F.col("file"), F.col("index_written") - F.col("written"), current))


def preflight(reports: DataFrame, expected: DataFrame) -> DataFrame:
    """A row an expected file (file): the exit code and what its tool said of it in its JSON
    report (file, text). A missing or unreadable report fails; a parse error, which
    faults the data, is told from any other exit; of several stages the one that spoke is named."""
    kind = "tool string, stage string, parse_error boolean, ok boolean, exit_code int, stages array<struct<ok:boolean>>"
    r = reports.select(F.col("file").alias("__f"), F.lit(True).alias("__there"), F.from_json("text", kind).alias("r"))
    d = expected.select("file").join(r, F.col("file") == F.col("__f"), "left")
    who = F.coalesce(F.when(F.size("r.stages") > 1, F.concat(F.col("r.tool"), F.lit(" at "), F.coalesce("r.stage", "r.tool"))), F.col("r.tool"), F.lit("?"))
    no = F.lit(False)
    how = F.when(F.col("__there").isNull(), "FAIL (no report)").when(F.col("r.ok").isNull() & F.col("r.parse_error").isNull(), "FAIL (unreadable report)")
    how = how.when(F.coalesce("r.parse_error", no), F.concat(F.lit("FAIL ("), who, F.lit(" rejected the data)"))).when(~F.coalesce("r.ok", no), F.concat(F.lit("FAIL ("), who, F.lit(" exited)"))).otherwise("PASS")
    return row(d, "consumer preflight", F.col("file"), F.col("r.exit_code"), how)


def header_layout(reads: DataFrame, maps: DataFrame, fields: Sequence[str], leaks: str) -> DataFrame:
    """Three rows a file of reads (file, header): no header matches the pattern of `leaks`; all
    carry `fields` as name=value in this order; the map (file, rows) has a row a read.
    Every header is seen. A file without a map fails."""
    names = F.transform(F.filter(F.slice(F.split("header", r"\s+"), 2, 1 << 20), lambda w: F.contains(w, F.lit("="))), lambda w: F.substring_index(w, "=", 1))
    same = F.coalesce(F.array_join(names, ",") == ",".join(fields), F.lit(False))
    x = reads.groupBy(F.col("file").cast("string").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("header").rlike(leaks)).alias("leaky"), F.count_if(~same).alias("other"))
    x = x.join(maps.select(F.col("file").cast("string").alias("__f"), F.col("rows").alias("__rows")), F.col("file") == F.col("__f"), "left")
    current = F.when(F.col("__rows").isNull(), "FAIL (absent)").otherwise(verdict(F.col("__rows") == F.col("n"), "map does not describe these reads"))
    return report(
        row(x, "no simulator truth", F.col("file"), F.col("leaky"), verdict(F.col("leaky") == 0, "leaks")),
        row(x, "measured layout", F.col("file"), F.col("other"), verdict(F.col("other") == 0, "other layout")),
        row(x, "read map current", F.col("file"), F.col("__rows") - F.col("n"), current))
