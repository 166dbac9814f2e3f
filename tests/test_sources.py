import gzip

import pytest
from pyspark.sql import functions as F

from quern.sources import readers, writers
from quern.streaming import streams


def lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, ordinal long")


def test_tables(spark, tmp_path):
    with gzip.open(tmp_path / "t.tsv.gz", "wt") as f:
        f.write("a\tb\n1\t\n2\tx\n")
    got = readers.table(spark, f"file://{tmp_path}/t.tsv.gz", "a int, b string").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, "x")]
    assert readers.table(spark, f"file://{tmp_path}/none.tsv", "a int").count() == 0
    writers.write_table(spark.createDataFrame([(1, None)], "a int, b string"), f"file://{tmp_path}/out", gzip=True)
    assert [tuple(r) for r in readers.table(spark, f"file://{tmp_path}/out", "a int, b string").collect()] == [(1, None)]


def test_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "x.txt").write_text("#c\nb\n\na\n")
    path = f"file://{tmp_path}/x.txt"
    assert sorted(r.value for r in readers.lines(spark, path, "#").collect()) == ["a", "b"]
    assert sorted((r.ordinal, r.value) for r in readers.first_lines(spark, path, 2).collect()) == [(0, "#c"), (1, "b")]
    writers.write_lines(readers.ordered_lines(spark, path), f"file://{tmp_path}/y", ["ordinal"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "y").glob("part-*"))) == "#c\nb\n\na\n"


def test_intervals_annotation_variants(spark):
    got = readers.intervals(lines(spark, "track x", "#y", "chr1\t5\t9\tn", "chr1\tz\t9", "chr2\t1\t2")).collect()
    assert [(r.chrom, r.start, r.end, r.name) for r in got] == [("chr1", 5, 9, "n"), ("chr2", 1, 2, None)]
    a = 'chr1\ts\t%s\t%d\t%d\t.\t+\t.\tgene_name "G"; transcript_id "T1";'
    t = readers.transcripts(lines(spark, a % ("exon", 30, 40), a % ("exon", 10, 20), a % ("CDS", 12, 20), a % ("gene", 1, 99))).first()
    assert [tuple(x) for x in t.exons] == [(10, 20), (30, 40)] and [tuple(x) for x in t.cds] == [(12, 20)]
    v = "chr1\t%d\t.\tA\tC,G\t.\tPASS\t.\tGT:DP\t%s:9"
    rows = readers.variants(lines(spark, "##x", v % (1, "0|2"), v % (2, "./."), v % (3, "0/3"), v % (4, "1"))).collect()
    assert [(r.pos, r.a, r.b, r.phased) for r in rows] == [(1, 0, 2, True), (4, 1, 1, False)]


def test_sequences_and_reads(spark):
    fa = {r.name: r.seq for r in readers.sequences(lines(spark, ">a x", "acg", "TRN", ">b", "GG")).collect()}
    assert fa == {"a": "ACGTNN", "b": "GG"}
    cut = spark.range(1).select(*[readers.window(F.lit("ACGT"), F.lit(a), F.lit(b)).alias(f"c{i}") for i, (a, b) in enumerate([(1, 3), (-5, 2), (3, 99), (4, 9), (2, 2)])]).first()
    assert list(cut) == ["CG", "AC", "T", "", ""]
    r = readers.reads(lines(spark, "@r1 1:N", "AC", "+", "II", "@r2", "GG")).orderBy("ordinal").collect()
    assert [(x.name, x.seq, x.whole) for x in r] == [("r1", "AC", True), ("r2", "GG", False)]
    s = readers.alignments(lines(spark, "@HD", "r\t16\tchr1\t5\t60\t3M\t*\t0\t0\tACG\tIII\tNM:i:2"), "NM", "AS").first()
    assert (s.flag, s.NM, s.AS) == (16, 2, None)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_carried(spark, block):
    marks = [None, "a", None, None, "b", None, None, None, "c"]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(marks)], "ordinal long, m string")
    got = [r.x for r in readers.carried(df, F.col("m"), "x", block).orderBy("ordinal").collect()]
    assert got == [None, "a", "a", "a", "b", "b", "b", "b", "c"]


def test_aliases(spark):
    df = spark.createDataFrame([("ENST1.2", 1), ("ENST1.3", 2), ("x.1", 3)], "id string, n int")
    assert {r.alias: r.n for r in readers.aliases(df, "id", ["n"]).collect()} == {"ENST1.2": 1, "ENST1.3": 2, "ENST1": 1, "x.1": 3}


def test_manifest_and_cards(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    r = writers.manifest(spark, f"file://{tmp_path}").first()
    assert (r.name, r.bytes, r.md5) == ("a.txt", 5, "5d41402abc4b2a76b9719d911017c592")
    ranks = spark.createDataFrame([("chr2",), ("chrX",), ("chrM",), ("other",)], "c string").select(writers.karyotypic(F.col("c")).alias("r")).collect()
    assert [x.r for x in ranks] == [2, 23, 25, 99]


@pytest.mark.parametrize("kind", ["distinct", "rate"])
def test_streams(spark, tmp_path, kind):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.txt").write_text("a\nb\na\n")
    df = streams.read_lines(spark, f"file://{src}")
    out = streams.distinct_names(df, ["value"], "time") if kind == "distinct" else streams.rate(df, "time", by=["value"])
    q = out.writeStream.format("memory").queryName(f"t_{kind}").outputMode("append" if kind == "distinct" else "complete").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    rows = spark.table(f"t_{kind}").collect()
    assert sorted(r.value for r in rows) == ["a", "b"] and (kind == "distinct" or {r.value: r.n for r in rows} == {"a": 2, "b": 1})
