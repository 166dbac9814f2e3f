import math
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import editing
from quern.functions import scalar as sc
from quern.functions import sequence as sq
from quern.operators import aggregates, checks, copynumber, sampling, sets, windows


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def test_interleave_is_the_scheduler(spark):
    draw = random.Random(1)
    for _ in range(3):
        sizes = {s: draw.randrange(1, 12) for s in "abc"}
        rows = [(s, i) for s, n in sizes.items() for i in range(n)]
        got = windows.interleave(spark.createDataFrame(rows, "s string, i int"), "s", ["i"]).orderBy("slot").collect()
        left, want = dict(sizes), []
        while any(left.values()):
            s = min((x for x in left if left[x]), key=lambda x: (-left[x] / sizes[x], x))
            want.append((s, sizes[s] - left[s]))
            left[s] -= 1
        assert [(r.s, r.i) for r in got] == want


def test_apportion(spark):
    rows = [("a", 10), ("b", 10), ("c", 1)]
    got = {r.k: r.seats for r in windows.apportion(spark.createDataFrame(rows, "k string, w long"), "w", 7, ["k"]).collect()}
    assert sum(got.values()) == 7 and got["a"] >= got["b"] >= got["c"]


def test_numbered_in_buckets_equals_one_sort(spark):
    rows = [(i * 37 % 101,) for i in range(101)]
    df = spark.createDataFrame(rows, "v int")
    assert all(r.rn == r.v + 1 for r in windows.numbered(df, ["v"], buckets=F.floor(F.col("v") / 10)).collect())


def test_lockstep_statuses(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "z")], "k int, ordinal int, n string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "q"), (2, 1, "r")], "k int, ordinal int, n string")
    got = {(r.k, r.ordinal): r.status for r in windows.lockstep(a, b, ["k"], "n").collect()}
    assert got == {(1, 1): "paired", (1, 2): "name differs", (1, 3): "right exhausted", (2, 1): "left exhausted"}


def test_nearest_rank(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), draw.randrange(50)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v long")
    large = {r.k: (r.p10, r.p90) for r in aggregates.nearest_rank_large(df, ["k"], "v", [0.1, 0.9]).collect()}
    plain = {r.k: r.x for r in df.groupBy("k").agg(aggregates.nearest_rank(F.col("v"), 0.9).alias("x")).collect()}
    for k in "ab":
        v = sorted(x for g, x in rows if g == k)
        at = lambda p: v[min(len(v) - 1, int(p * len(v)))]
        assert large[k] == (at(0.1), at(0.9)) and plain[k] == at(0.9)


def test_rescale_to_budget(spark):
    df = spark.createDataFrame([("a", 6.0), ("a", 4.0), ("b", 1.0), ("c", 0.0)], "k string, v double")
    budget = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 1.0)], "k string, budget double")
    got = sorted((r.k, r.scaled) for r in aggregates.rescale_to_budget(df, ["k"], "v", budget, "budget").collect())
    assert got == [("a", 2.0), ("a", 3.0), ("b", 1.0), ("c", 0.0)]


def test_weighted_draws(spark):
    table = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 3.0)], "i string, w double")
    draws = spark.range(4000).select(F.col("id").alias("key"))
    got = {r.i: r["count"] for r in sampling.weighted_draws(table, "i", "w", draws, "key", 1).groupBy("i").count().collect()}
    assert sum(got.values()) == 4000 and set(got) == {"a", "c"} and abs(got["a"] / 4000 - 0.25) < 0.03


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    a, b = (sorted(r.id for r in sampling.thin(d, 3, ["id"], F.lit(0.3)).collect()) for d in (df, df.repartition(7)))
    assert a == b and 100 < len(a) < 200


def test_ranked_sizes(spark):
    """Against the halving and the repair in plain Python."""
    cases = [(1, 5, 100), (2, 30, 1200), (3, 3, 3), (4, 10, 12), (5, 40, 41), (6, 4, 1000), (7, 6, 2), (8, 0, 5)]

    def plain(n, total):
        low, high = 0.1, 4.0
        for _ in range(60):
            mid = (low + high) / 2
            w = [k**-mid for k in range(1, n + 1)]
            low, high = (mid, high) if sum(w[:3]) / sum(w) < 0.5 else (low, mid)
        w = [k ** -((low + high) / 2) for k in range(1, n + 1)]
        sizes = [max(1, int(total * x / sum(w) + 0.5)) for x in w]
        k = 0
        while sum(sizes) != total and not (sum(sizes) > total and max(sizes) == 1):
            if sum(sizes) < total or sizes[k % n] > 1:
                sizes[k % n] += 1 if sum(sizes) < total else -1
            k += 1
        return sizes

    df = spark.createDataFrame(cases, "g int, n int, total long")
    got = sampling.ranked_sizes(df, "n", "total", 0.5, 3).orderBy("g", "rank").collect()
    assert [(r.g, r.rank, r.size) for r in got] == [(g, k, s) for g, n, total in cases if n for k, s in enumerate(plain(n, total), 1)]


def test_prefix_shadows_and_containment(spark):
    names = spark.createDataFrame([("ab",), ("abc",), ("b",), ("a",)], "n string")
    assert {tuple(r) for r in sets.prefix_shadows(names, "n").select("shadowed", "by").collect()} == {("ab", "abc"), ("a", "ab"), ("a", "abc")}
    a = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y")], "k int, e string")
    got = sets.containment(a, spark.createDataFrame([(9, "y"), (9, "z")], "k int, e string"), "k", "e").collect()
    assert [(r.a_key, r.b_key, r.containment) for r in got] == [(1, 9, 0.5)]


def test_containment_with_few_and_many_elements(spark, monkeypatch):
    a = spark.range(300).selectExpr("id % 7 AS k", "concat('e', id % 40) AS e").union(spark.sql("SELECT 1L, CAST(null AS string)"))
    b = spark.range(500).selectExpr("id % 9 AS k", "concat('e', id % 90) AS e").union(spark.sql("SELECT 1L, CAST(null AS string)"))
    few = sorted(map(tuple, sets.containment(a, b, "k", "e").collect()))
    monkeypatch.setattr(sets, "FEW_ELEMENTS", 3)
    assert few and few == sorted(map(tuple, sets.containment(a, b, "k", "e").collect()))


def test_unresolved_rows_stop(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    out = sets.lookup_chain(df, [(spark.createDataFrame([(1, "one")], "k int, v string"), "k", "k", "v")], "v")
    with pytest.raises(ValueError):
        sets.require_resolved(out, "v")
    assert sets.require_resolved(out.where("k = 1"), "v").count() == 1


def test_sequences(spark):
    s = F.col("s")
    assert one(spark, sq.reverse_complement(s), s="AACGTNx") == "xNACGTT"
    assert one(spark, sq.translate(s), s="ATGGCNTAAA") == "MX*"
    assert one(spark, sq.translate(s, 1), s="ATGGCC") == "W"
    assert one(spark, sq.translate(s), s="AT") == ""
    assert one(spark, sq.gc_fraction(s), s="") == 0 and one(spark, sq.gc_fraction(s), s="GCAN") == 0.5
    assert one(spark, sq.kmers(s, 3), s="ACGNACG") == ["ACG"] and one(spark, sq.kmers(s, 3), s="AC") == []
    assert one(spark, sq.longest_orf(s, 2), s="AATGGCCTAAATGAAATAG") in ("MA", "MK")
    assert one(spark, sq.wrap(s, 3), s="abcdefg") == "abc\ndef\ng" and one(spark, sq.wrap(s, 3), s="abcdef") == "abc\ndef"
    assert one(spark, sq.cigar_sum(s, "M=X"), s="5S10M2I3D4M") == 14
    assert one(spark, sq.longest_run(s), s="aabbbc") == 3 and one(spark, sq.longest_run(s), s="") == 0
    assert one(spark, sq.phred_mean(s), s="I+") == pytest.approx(-10 * math.log10((1e-4 + 1e-1) / 2))


def test_codons_are_letters(spark):
    s = F.col("s")
    assert one(spark, sq.translate(s), s="AUG012TTT") == "MXF"
    assert one(spark, sq.longest_orf(s, 2), s="ATG012TTTTAA") == "MXF"


def test_scalars(spark):
    s = F.col("s")
    assert [one(spark, sc.truth(s), s=x) for x in ("True", " YES", "1", "no", "")] == [True, True, True, False, False]
    v = one(spark, sc.parse_variant(s), s="chr1:123G>AT")
    assert (v.chrom, v.pos, v.ref, v.alt) == ("chr1", 123, "G", "AT") and one(spark, sc.parse_variant(s), s="junk").pos is None
    assert one(spark, sc.slug(s), s="/a b//c.d_") == "a_b__c.d"
    assert one(spark, sc.without_mate(s), s="r1/2") == "r1" and one(spark, sc.without_mate(s), s="r1/12") == "r1/12"
    assert one(spark, sc.infix(s, "#", "x"), s="a#b#c") == "a#xb#c" and one(spark, sc.infix(s, "#", "x"), s="abc") == "abc"
    assert one(spark, sc.clean_pileup(s), s="^]a+2acG$,-1t") == "AG,"
    assert one(spark, sc.clean_pileup(s), s="^+a+12acgtacgtacgtT-10NNNNNNNNNNg*+1") == "ATG*"
    assert one(spark, sc.key_values(a=F.lit("1"), b=F.lit(""), c=F.lit(None).cast("string"), d=F.lit("x")), s="") == "a=1;d=x"


def test_edits():
    e = lambda p, r, a: {"pos": p, "ref": r, "alt": a}
    assert editing.edit("ACGTACGT", [e(1, "C", "T"), e(4, "AC", "A")]) == ("ATGTAGT", 2, [])
    assert editing.edit("ACGT", [e(0, "AC", "A"), e(1, "C", "G"), e(9, "A", "C"), e(2, "T", "A"), e(3, "T", "*"), e(3, "T", "?")]) == ("AGT", 2, ["overlapping_edit", "ref_mismatch", "bad_allele", "out_of_range"])
    assert editing.edit(None, []) == (None, 0, [])


def test_left_alignment_keeps_the_sequence():
    draw = random.Random(6)
    for _ in range(300):
        seq = "".join(draw.choice("AC") for _ in range(12))
        p, n = draw.randrange(1, 11), draw.randrange(1, 4)
        ref, alt = (seq[p - 1 : p + n], seq[p - 1]) if draw.random() < 0.5 else (seq[p - 1], seq[p - 1] + "".join(draw.choice("AC") for _ in range(n)))
        q, r, a = editing.leftmost(seq, p - 1, ref, alt)
        assert seq[q : q + len(r)] == r and seq[:q] + a + seq[q + len(r) :] == seq[: p - 1] + alt + seq[p - 1 + len(ref) :] and q <= p - 1 and r and a
        assert editing.leftmost(seq, q, r, a) == (q, r, a)


@pytest.mark.parametrize("pos,ref,alt,want", [(5, "T", "C", "synonymous"), (3, "G", "T", "missense"), (3, "GCT", "TAA", "nonsense"), (0, "A", "C", "start_loss"), (4, "C", "CA", "frameshift"), (3, "GCT", "", "inframe_deletion"), (9, "T", "C", "stop_loss"), (3, "A", "C", "ref_mismatch")])
def test_consequences(pos, ref, alt, want):
    assert editing.classify("ATGGCTGAATAA", "GGCTAA", pos, ref, alt)[0] == want


def test_copy_numbers(spark):
    closed = spark.createDataFrame([("T", "T", 0), ("A", "A", 0), ("T", "A", 1)], "ancestor string, descendant string, depth int")
    seg = spark.createDataFrame([("T", 0, 100, 2, 0, 1), ("A", 50, 60, 3, 1, 2), ("A", 50, 60, 4, 1, 3)], "clone string, start long, `end` long, cn_a int, cn_b int, seg long")
    points = spark.createDataFrame([(1, "A", 55), (2, "A", 60), (3, "T", 55), (4, "A", 100)], "key int, clone string, pos long")
    got = {r.key: (r.cn_a, r.cn_b) for r in copynumber.copies_at(points, seg, closed, ["key"], 16).collect()}
    assert got == {1: (4, 1), 2: (2, 0), 3: (2, 0), 4: (1, 1)}


def test_verdicts(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (None,)], "v double")
    assert [r.x for r in df.select(checks.band(F.col("v"), 0, 1).alias("x")).collect()] == ["PASS", "FAIL (out of bound)", "FAIL (nothing measured)"]
    assert df.limit(1).select(checks.band(F.col("v")).alias("x")).first().x == "reported, no bound"
    assert checks.none_of(df, "c").first().verdict == "FAIL (violations)" and checks.none_of(df.limit(0), "c").first().verdict == "PASS"
    assert checks.equal_counts(df.limit(0), df.limit(0), "c").first().verdict == "FAIL (nothing measured)"
    assert checks.equal_counts(df, df, "c").first().verdict == "PASS" and checks.equal_counts(df, df.limit(1), "c").first().verdict == "FAIL (counts differ)"
    k = df.select(F.col("v").alias("k"))
    assert checks.set_equality(k, k.limit(1), "k", "c").first().verdict == "FAIL (sets differ)"
    rows = checks.none_of(df.limit(0), "c")
    assert [checks.failures(x).first().status for x in (rows, checks.none_of(df, "d"), rows.limit(0))] == [0, 1, 2]


def test_haplotype_shares(spark):
    rows = [(1, 2, 0, "dominant", 0), (2, 1, 3, "silenced", 1), (3, 1, 1, "balanced", 0), (4, 0, 0, "dominant", 0), (5, 1, 3, None, None)]
    d = spark.createDataFrame(rows, "k int, cn_a int, cn_b int, s string, m int")
    got = {(r.k, r.hap): (round(r.share, 6), r.dosage) for r in copynumber.haplotype_shares(d, ["k"], F.col("s"), F.col("m"), F.lit(2)).collect()}
    assert got[1, 0] == (1.0, 1.0) and got[1, 1] == (0.0, 1.0)  # no copies, no expression
    assert got[2, 0] == (0.9, 2.0) and got[2, 1] == (0.1, 2.0)
    assert got[3, 0][0] == 0.5 and got[4, 0] == got[4, 1] == (0.0, 0.0) and got[5, 1][0] == 0.75


def test_weighted_draws_by_class(spark):
    table = spark.createDataFrame([("x", 1, 1.0), ("x", 2, 3.0), ("y", 1, 0.0), ("y", 3, 2.0), ("z", 1, None)], "c string, i int, w double")
    draws = spark.range(2000).select(F.col("id"), F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z"), F.lit("q")), (F.col("id") % 4 + 1).cast("int")).alias("c"))
    got = {(r.c, r.i): r["count"] for r in sampling.weighted_draws(table, "i", "w", draws, "id", 1, by=["c"]).groupBy("c", "i").count().collect()}
    assert set(got) == {("x", 1), ("x", 2), ("y", 3)} and got["y", 3] == 500 and got["x", 1] + got["x", 2] == 500 and 80 < got["x", 1] < 170
    z = [r.z for r in spark.range(4000).select(sampling.normal(3, "id").alias("z")).collect()]
    assert abs(sum(z) / 4000) < 0.06 and abs(sum(x * x for x in z) / 4000 - 1) < 0.1


def test_draws_from_a_large_table_are_not_broadcast(spark):
    table, draws = spark.range(5).select(F.col("id").alias("i"), F.lit(1.0).alias("w")), spark.range(9).select(F.col("id").cast("string").alias("key"))
    d = sampling.weighted_draws(table, "i", "w", draws, "key", 1, buckets=F.floor(F.col("i") / 2))
    joins = [line for line in d._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "__cell" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0] and d.count() == 9


def test_format_checks(spark):
    names = spark.createDataFrame([("m1",), ("m1",), ("x_chr3",)], "n string")
    got = {r.check: r for r in checks.read_names(names, "n").collect()}
    assert got["read names unique"].value == 1 and got["read names carry no truth"].value == 1
    assert {r.verdict for r in checks.read_names(names.limit(0), "n").collect()} == {"FAIL (nothing measured)"}
    assert {r.verdict for r in checks.conserved(names, spark.createDataFrame([(1,), (2,)], "k int"), "k", names).collect()} == {"PASS"}
    empty = spark.createDataFrame([], "k int")
    assert {r.verdict for r in checks.conserved(names.limit(0), empty, "k", empty).collect()} == {"FAIL (nothing measured)"}
    kind = "f string, trb string, tra string, trb_v string, trb_j string, tra_v string, tra_j string, antigen string"
    good = [("a", "CASSF", "CAVF", "v", "j", "v", "j", "x")] * 5
    bad = [("b", None, "CACF", "v", "", "v", "j", None), ("b", "CF", "C", "v", "j", "v", None, "")]
    v = {(r.file, r.check): (r.value, r.verdict) for r in checks.receptor_truth(spark.createDataFrame(good + bad, kind), "f").collect()}
    assert {x[1] for (f, _), x in v.items() if f == "a"} == {"PASS"}
    assert v["b", "cdr3_anchored_C_to_F"][0] == 2 and v["b", "cdr3_internal_cysteine"] == (1, "FAIL (too many)") and v["b", "clonotype_names_v_and_j"][0] == 0
    files = spark.createDataFrame([("a", "0123abcd", "m1", "R", 200), ("b", None, "x", None, None)], "file string, id string, unit string, model string, index_bytes long")
    reads = spark.createDataFrame([("a", f"m1/{i}/ccs", {"np": str(i), "ec": "1"}) for i in range(5)] + [("b", None, {"np": "1"})], "file string, name string, tags map<string,string>")
    v = {(r.file, r.check): r.verdict for r in checks.long_read_format(files, reads, ["np", "ec"]).collect()}
    assert len(v) == 14 and {x for (f, _), x in v.items() if f == "a"} == {"PASS"} and not {x for (f, _), x in v.items() if f == "b"} & {"PASS"}


@pytest.mark.parametrize("block", [4, 100])
def test_packed(spark, block):
    rows = [(g, i) for g in ("a", "b", None) for i in range(10)]
    got = windows.packed(spark.createDataFrame(rows, "g string, i int"), ["g"], ["i"], F.lit(3) - F.col("array") % 3, 2, block, F.floor(F.col("i") / 4)).collect()
    assert len(got) == 30
    for g in ("a", "b", None):
        mine = sorted((r.array, r.member, r.i) for r in got if r.g == g)
        assert [x[2] for x in mine] == list(range(10))
        want, at = [], 0
        for start in range(0, 10, block):
            at, array, end = start, 0, min(10, start + block)
            while at < end:
                n = min(max(1, min(2, 3 - array % 3)), end - at)
                want += [(start // block * block + array, m, at + m) for m in range(n)]
                at, array = at + n, array + 1
        assert mine == want
    assert windows.packed(spark.createDataFrame([], "g string, i int"), ["g"], ["i"], F.lit(3), 2).count() == 0


def test_pass_counts_and_identity(spark):
    rows = [("a", 3, 6.0), ("a", 5, 0.0), ("a", 8, 4.0), ("a", 9, None), ("a", None, 1.0), ("b", 0, 2.0), ("b", 4, None)]
    got = {r.f: r for r in aggregates.pass_counts(spark.createDataFrame(rows, "f string, np int, ec double"), ["f"], "np", "ec").collect()}
    assert (got["a"].reads, got["a"].np_mean, got["a"].np_median, got["a"].ec_over_np) == (4, 6.25, 6.5, 1.25)
    assert got["b"].reads == 1 and got["b"].np_median == 4 and got["b"].ec_over_np is None
    rows = [("a", "2S8M1I1D", 3, "++++"), ("a", "10=", 0, None), ("b", None, None, "")]
    got = {r.f: r for r in aggregates.alignment_identity(spark.createDataFrame(rows, "f string, c string, nm long, q string"), ["f"], "c", "nm", "q").collect()}
    a = got["a"]
    assert (a.reads, a.aligned, a.nm, a.inserted, a.deleted) == (2, 20, 3, 1, 1)
    assert a.true_identity == pytest.approx(0.85) and a.claimed_identity == pytest.approx(0.9) and a.ratio == pytest.approx(1.5) and a.clipped_fraction == pytest.approx(2 / 22)
    assert got["b"].true_identity is None and got["b"].claimed_identity is None


def test_file_checks(spark):
    tasks = spark.createDataFrame([("FAILED", 9), ("FAILED", 1), ("CANCELLED by 7", 9), ("OUT_OF_MEMORY", 0), (None, None), ("COMPLETED", 0)], "s string, c int")
    got = [(r.f["class"], r.f["retry"]) for r in tasks.select(checks.failure_class(F.col("s"), F.col("c"), 9).alias("f")).collect()]
    assert got == [("failed verdict", False), ("retryable", True), ("cancelled", False), ("out of memory", True), ("unknown", False), ("ok", False)]
    files = spark.createDataFrame([("a", True, True, 5, 5), ("b", None, True, 5, 4), ("c", False, True, 5, None), ("d", True, False, 5, None)], "file string, complete boolean, indexed boolean, written long, index_written long")
    got = {(r.file, r.check): r.verdict for r in checks.complete_and_indexed(files).collect()}
    assert got["a", "complete"] == got["a", "index present and current"] == "PASS" and got["b", "complete"].startswith("FAIL")
    assert got["b", "index present and current"] == "FAIL (stale index)" and got["c", "index present and current"] == "FAIL (no index)" and ("d", "index present and current") not in got
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "file string")
    reports = spark.createDataFrame([("a", '{"tool":"t","ok":true}'), ("b", None), ("c", '{"tool":"t","stage":"u","parse_error":true,"stages":[{"ok":true},{"ok":false}]}')], "file string, text string")
    got = {r.file: r.verdict for r in checks.preflight(reports, expected).collect()}
    assert got == {"a": "PASS", "b": "FAIL (unreadable report)", "c": "FAIL (t at u rejected the data)", "d": "FAIL (no report)"}
    reads = spark.createDataFrame([("a", "@x p=1 q=2"), ("a", "@x\tp=1  q=3"), ("b", "@x q=1 p=2"), ("b", None), ("c", "@x p=1 q=1 hap=2")], "file string, header string")
    maps = spark.createDataFrame([("a", 2), ("b", 3)], "file string, rows long")
    got = {(r.file, r.check): r.verdict for r in checks.header_layout(reads, maps, ["p", "q"], "hap").collect()}
    assert {v for (f, _), v in got.items() if f == "a"} == {"PASS"}
    assert got["b", "measured layout"] == "FAIL (other layout)" and got["b", "read map current"].startswith("FAIL (map") and got["c", "read map current"] == "FAIL (absent)" and got["c", "no simulator truth"] == "FAIL (leaks)"
