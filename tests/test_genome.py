import random

import pytest
from pyspark.sql import functions as F

from quern.operators import genome


def test_surroundings_and_runs(spark):
    draw = random.Random(3)
    seq = "".join(draw.choice("AACG") for _ in range(300))
    blocks = spark.createDataFrame([("c", i, seq[i * 16 : i * 16 + 16]) for i in range(19)], "contig string, block long, seq string")
    sites = spark.createDataFrame([("c", i) for i in range(300)] + [("d", 4)], "contig string, pos long")
    got = {r.pos: r for r in genome.surroundings(sites, blocks, 16, 50).withColumn("run", genome.run_length(F.col("text"), F.col("at"))).collect()}
    assert len(got) == 300
    for p, r in got.items():
        assert r.text == seq[max(0, p - 50) : p + 50] and r.text[r.at] == seq[p]
        s, best = seq[max(0, p - 12) : p + 13], 1
        c = p - max(0, p - 12)
        for i in (c - 1, c, c + 1):
            if 0 <= i < len(s):
                a = b = i
                while a and s[a - 1] == s[i]:
                    a -= 1
                while b + 1 < len(s) and s[b + 1] == s[i]:
                    b += 1
                best = max(best, b - a + 1)
        assert r.run == best, p


def test_context_of_bare_sites(spark):
    sites = spark.createDataFrame([("c", 5), ("c", 5), ("c", None), ("d", 1)], "contig string, pos long")
    blocks = spark.createDataFrame([("c", 0, "ACGTACGTAC")], "contig string, block long, seq string")
    spans = spark.createDataFrame([], "contig string, start long, `end` long, name string")
    hets = spark.createDataFrame([("c", 5), ("c", 9), ("c", None)], "contig string, pos long")
    got = {r.contig: r for r in genome.context_features(sites, blocks, 64, hets, spans, spans, spans, spans).collect()}
    assert set(got) == {"c", "d"}
    assert got["c"].hets_near == 1 and got["c"].nearest_het == 4 and got["c"].gc == 0.5 and not got["c"].on_target and got["c"].repeat is None
    assert got["d"].gc is None and got["d"].homopolymer_run is None and not got["d"].segdup


def test_epitopes(spark):
    c = spark.createDataFrame([(1, "MNPQR", "MNAQR", ["A"]), (2, "KKKKK", "KKKKK", []), (3, None, None, None)], "key int, mutant string, wild string, lost array<string>")
    peps = spark.createDataFrame([(1, "NPQ"), (1, "NPQ"), (1, "PQR"), (9, "AAA")], "key int, pep string")
    score = lambda p, a: (F.when(a == "A", 0.4).otherwise(1.5) + F.when(p == "PQR", 1.0).otherwise(0.0), F.when(F.contains(p, F.lit("A")), 90.0).otherwise(30.0))
    got = {r.key: r for r in genome.epitopes(c, peps, "AB", score).collect()}
    one = got[1]
    assert (one.best_peptide, one.best_allele, one.tier, one.n_low, one.best_is_lost) == ("NPQ", "A", "strong", 2, True)
    assert (one.retained_allele, one.retained_rank, one.retained_tier) == ("B", 1.5, "weak")
    assert (one.wt_peptide, one.agretopicity) == ("NAQ", 3.0)
    assert got[2].tier == got[3].tier == "na" and got[2].n_low == 0 and got[2].agretopicity is None and not got[3].best_is_lost
    assert set(got) == {1, 2, 3}


@pytest.mark.parametrize("frame,want", [(True, {(1, 1)}), (False, set())])
def test_junctions(spark, frame, want):
    rows = [(1, ["ATG", "AAAA"], ["CC", "GGGTTTCCC"]), (2, ["ATG"], ["CC", "GGG"]), (3, ["TAA", "CCC"], ["CC", "GGGTTTCCC"]), (4, [], None)]
    d = spark.createDataFrame(rows, "k int, left array<string>, right array<string>")
    got = genome.junctions(d, ["k"], frame, 4, 1).collect()
    assert {(r.i, r.j) for r in got if r.k == 1} == want
    assert {r.k for r in got} <= {1}
    if got:
        assert got[0].protein_len == 4 and got[0].options == 1


def test_uniform_slices(spark):
    kind = "k int, ordinal int, d_start long, d_end long, contig string, r_start long, r_end long, strand string, inserted boolean"
    rows = [
        (1, 0, 1, 100, "a", 1, 100, "+", False), (1, 1, 101, 103, "a", 100, 102, "+", True), (1, 2, 104, 153, "a", 101, 150, "+", False),
        (1, 3, 154, 156, "b", 7, 9, "-", False), (2, 0, 1, 5, "a", None, None, "+", True), (2, 1, 6, 25, "a", 91, 110, "-", False),
    ]
    cuts = spark.createDataFrame([("a", 50), ("a", 50), ("a", 98), ("b", 500), ("a", None)], "contig string, pos long")
    got = sorted((r.k, r.start, r.end, r.contig, r.band) for r in genome.uniform_slices(spark.createDataFrame(rows, kind), cuts, ["k"], 4).collect())
    # 98..100 is shorter than 4 and goes to the slice before it, as does the insert; b is another contig.
    assert got == [(1, 1, 49, "a", None), (1, 50, 103, "a", 50), (1, 104, 153, "a", 98), (1, 154, 156, "b", None), (2, 1, 5, "a", None), (2, 6, 18, "a", 98), (2, 19, 25, "a", 50)]


def test_derived_plan(spark):
    lengths = spark.createDataFrame([("a", 100), ("b", 50), ("c", 30)], "contig string, length long")
    events = spark.createDataFrame(
        [("a", 1, "DEL", 20, 11, 0), ("a", 2, "DUP", 31, 40, 0), ("a", 3, "INV", 40, 45, 0), ("a", 4, "INS", 60, 60, 7), ("a", 5, "DEL", 2, 3, 0), ("a", 6, "INV", None, 9, 0), ("z", 7, "DEL", 9, 9, 0)],
        "contig string, event int, kind string, start long, `end` long, ins_len long")
    none = spark.createDataFrame([], "event string, a string, pos_a long, b string, pos_b long")
    move = spark.createDataFrame([("t", "a", 70, "b", 20)], none.schema)
    cut = spark.createDataFrame([("t", "a", 35, "b", 20), ("u", "c", 3, "c", 9)], none.schema)

    def plan(moves):
        pieces, report = genome.derived_plan(lengths, events, moves, 5)
        rows = {}
        for r in sorted(pieces.collect(), key=lambda r: (r.contig, r.ordinal)):
            rows.setdefault(r.contig, []).append((r.source, r.r_start, r.r_end, r.kind, r.d_end - r.d_start + 1))
        return rows, {(r.event, r.contig): r.status for r in report.collect()}

    whole = [("a", 1, 10, "ref", 10), ("a", 21, 30, "ref", 10), ("a", 31, 40, "ref", 10), ("a", 31, 40, "dup", 10), ("a", 41, 59, "ref", 19), ("a", 60, 60, "ref", 1), ("a", 60, 60, "insert", 7), ("a", 61, 100, "ref", 40)]
    rows, report = plan(none)
    assert rows == {"a": whole, "b": [("b", 1, 50, "ref", 50)], "c": [("c", 1, 30, "ref", 30)]}
    assert report == {("1", "a"): "applied", ("2", "a"): "applied", ("3", "a"): "dropped", ("4", "a"): "applied", ("5", "a"): "outside"}
    rows, report = plan(move)
    assert rows["a"] == whole[:-1] + [("a", 61, 70, "ref", 10), ("b", 21, 50, "ref", 30)]
    assert rows["b"] == [("b", 1, 20, "ref", 20), ("a", 71, 100, "ref", 30)]
    assert report["t", "a"] == report["t", "b"] == "placed"
    rows, report = plan(cut)  # inside of a duplicate
    assert rows["a"] == whole and report["t", "a"] == "not placed" and report["u", "c"] == "skipped"


def test_junction_contigs(spark):
    seq = "ACGTTGCAAC" * 4
    blocks = spark.createDataFrame([("c", i, seq[i * 8 : i * 8 + 8]) for i in range(5)] + [("d", 0, "TTTTTTTT")], "contig string, block long, seq string")
    rows = [
        (1, "DEL", "c", 10, None, 20, None), (2, "DUP", "c", 10, None, 20, None), (3, "INV", "c", 10, None, 20, None), (4, "TRA", "c", 10, "d", 2, None), (5, "INS", "c", 10, None, None, "GGGGGGG"),
        (6, "INS", "c", 10, None, 10, None), (7, "CNV", "c", 10, None, 20, None), (8, "DEL", "c", None, None, 20, None), (9, "DEL", "x", 10, None, 20, None), (10, "DEL", "c", 2, None, 39, None),
    ]
    events = spark.createDataFrame(rows, "event int, kind string, contig string, start long, end_contig string, `end` long, element string")
    got = {(r.event, r.side): r.sequence for r in genome.junction_contigs(events, blocks, 8, 4).collect()}
    turned = seq[16:20][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == {
        (1, ""): seq[6:10] + seq[19:23], (2, ""): seq[16:20] + seq[9:13], (3, ""): seq[6:10] + turned, (4, ""): seq[6:10] + "TTTT",
        (5, "5p"): seq[6:10] + "GGGG", (5, "3p"): "GGGG" + seq[10:14], (10, ""): seq[0:2] + seq[38:40],
    }
