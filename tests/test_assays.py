"""Tags, alignments, adapters, haplotypes, background changes and sidecars by hand-made cases."""

import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from quern.functions import messagepack as mp
from quern.functions.search import approximate_hits
from quern.operators import adapters, alignments, bundles, passengers, phasing, sets, spikeins
from quern.sources import readers

MESSAGES = [
    (b"", True, []),
    (b"\x01\xff\xe0", True, [("", "int", "1"), ("", "int", "-1"), ("", "int", "-32")]),
    (b"\xcc\xff\xcd\x01\x00\xce" + b"\xff" * 4, True, [("", "int", "255"), ("", "int", "256"), ("", "int", str(2**32 - 1))]),
    (b"\xcf" + b"\xff" * 8, True, [("", "int", str(2**64 - 1))]),
    (b"\xd0\x80\xd1\xff\x7f\xd2\x80\x00\x00\x00\xd3" + struct.pack(">q", -(2**63)), True, [("", "int", "-128"), ("", "int", "-129"), ("", "int", str(-(2**31))), ("", "int", str(-(2**63)))]),
    ("\xa3abc".encode("latin-1") + b"\xd9\x02\xc3\xa9\xa0", True, [("", "str", "abc"), ("", "str", "é"), ("", "str", "")]),
    (b"\xc4\x02\x00\xff\xd4\x05\xaa\xc7\x03\x09abc", True, [("", "bin", "00ff"), ("", "ext", "05aa"), ("", "ext", "09616263")]),
    (b"\xc0\xc2\xc3", True, [("", "nil", None), ("", "bool", "false"), ("", "bool", "true")]),
    (b"\x93\x01\x92\x02\x03\x04", True, [("", "array", "3"), ("0", "int", "1"), ("1", "array", "2"), ("1.0", "int", "2"), ("1.1", "int", "3"), ("2", "int", "4")]),
    (b"\x82\xa1a\x81\xa1b\x01\xa1c\x90", True, [("", "map", "2"), ("a", "map", "1"), ("a.b", "int", "1"), ("c", "array", "0")]),
    (b"\x82\xa1a\x81\xa1b\x01\xa1c", False, [("", "map", "2"), ("a", "map", "1"), ("a.b", "int", "1")]),
    (b"\xdd\x00\x00\x00\x01\xdf\x00\x00\x00\x01\x07\x91\x80", True, [("", "array", "1"), ("0", "map", "1"), ("0.7", "array", "1"), ("0.7.0", "map", "0")]),
    (b"\x01\xa5ab", False, [("", "int", "1")]),
    (b"\xc1", False, []),
    (b"\xd9", False, []),
    (b"\xdc\x00", False, []),
]
FLOATS = [0.0, -0.0, 3.14, -1.5e-310, 5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), 2.0**-1022]


def test_messagepack_is_read(spark):
    df = spark.createDataFrame([(i, bytearray(m)) for i, (m, _, _) in enumerate(MESSAGES)], "i int, b binary")
    got = df.select("i", mp.unpacked(F.col("b")).alias("u")).orderBy("i").collect()
    for r, (m, whole, values) in zip(got, MESSAGES):
        assert (r.u.whole, [(v.path, v.kind, v.text) for v in r.u["values"]]) == (whole, values), m
    assert spark.createDataFrame([(None,)], "b binary").select(mp.unpacked(F.col("b")).alias("u")).first().u is None


def test_messagepack_floats(spark):
    df = spark.createDataFrame([(i, bytearray(b"\xcb" + struct.pack(">d", x) + b"\xca" + struct.pack(">f", min(max(x, -1e38), 1e38)))) for i, x in enumerate(FLOATS)], "i int, b binary")
    for r, x in zip(df.select("i", mp.unpacked(F.col("b")).alias("u")).orderBy("i").collect(), FLOATS):
        want = [x, struct.unpack(">f", struct.pack(">f", min(max(x, -1e38), 1e38)))[0]]
        assert [v.number for v in r.u["values"]] == want


def test_messagepack_round_trip(spark):
    ints = [0, 127, 128, 255, 256, 65535, 65536, 2**32 - 1, 2**32, 2**62, -1, -32, -33, -128, -129, -32768, -32769, -(2**31), -(2**31) - 1, -(2**62), None]
    df = spark.createDataFrame([(i, n, "é" * (i * 13), None if i == 3 else i % 2 == 0) for i, n in enumerate(ints)], "i int, n long, s string, f boolean")
    value = mp.pack_map(n=mp.pack_int(F.col("n")), s=mp.pack_text(F.col("s")), l=mp.pack_list(F.array(mp.pack_flag(F.col("f")), mp.pack_bytes(F.encode("s", "UTF-8")))), none=mp.pack_text(F.lit(None).cast("string")))
    for r in df.select("*", mp.unpacked(mp.packed(value)).alias("u")).collect():
        got = {v.path: (v.kind, v.text) for v in r.u["values"]}
        assert r.u.whole and got[""] == ("map", "4") and got["none"] == ("nil", None)
        assert got["n"] == (("nil", None) if r.n is None else ("int", str(r.n))) and got["s"] == ("str", r.s)
        assert got["l.0"] == (("nil", None) if r.f is None else ("bool", str(r.f).lower())) and got["l.1"] == ("bin", r.s.encode().hex())


def blocks(spark, contigs, width):
    return spark.createDataFrame([(c, i // width, s[i : i + width]) for c, s in contigs.items() for i in range(0, len(s), width)], "contig string, block long, seq string")


def runs_of(s, least):
    out, i = [], 0
    while i < len(s):
        j = i
        while j < len(s) and s[j] == s[i]:
            j += 1
        if j - i >= least and s[i] in "ACGT":
            out.append((s[i], i, j))
        i = j
    return out


@pytest.mark.parametrize("width", [1, 3, 7, 64])
def test_letter_runs_go_over_block_borders(spark, width):
    r = random.Random(3)
    contigs = {"a": "".join(r.choice("AACN") for _ in range(150)), "b": "A" * 40, "c": "ACGT", "d": "NNNNN"}
    got = alignments.letter_runs(blocks(spark, contigs, width), width, 3).collect()
    assert sorted(map(tuple, got)) == sorted((c, *x) for c, s in contigs.items() for x in runs_of(s, 3))


def test_indels_inside_and_outside_of_runs(spark):
    contigs = {"a": "ACGTAAAAAACGTACGTCCCCCCCGT"}
    rows = [
        (1, "a", 0, "4M2I6M1D3M"),  # an insertion before the run, at its last letter before; a deletion behind the run
        (2, "a", 2, "3S4M1D5M"),  # a deletion in the run
        (3, "a", 4, "2I4M10N5M"),  # an insertion first, at the read's own first letter; a gap that counts for nothing
        (4, "a", 18, "2=1X1I3M"), (5, "a", None, "4M"), (6, "a", 3, "*"), (7, "a", 3, None), (8, "b", 0, "2M1D2M"),
    ]
    reads = spark.createDataFrame(rows, "read int, contig string, pos long, cigar string")
    got = {r.context: r for r in alignments.indels_in_runs(reads, ["read"], blocks(spark, contigs, 5), 5, least=6).collect()}
    inside = {p for _, s, e in runs_of(contigs["a"], 6) for p in range(s, e)}
    want = {True: [0] * 5, False: [0] * 5}
    for _, c, pos, cigar in rows:
        if pos is None or not cigar or cigar == "*":
            continue
        at = pos
        for n, op in re.findall(r"(\d+)([MIDNS=X])", cigar):
            n = int(n)
            if op in "M=X":
                for p in range(at, at + n):
                    want[c == "a" and p in inside][0] += 1
            elif op in "ID":
                side = c == "a" and (at if op == "D" else max(at - 1, pos)) in inside
                want[side][1 if op == "I" else 2] += 1
                want[side][3 if op == "I" else 4] += n
            at += n if op in "MDN=X" else 0
    for side, name in ((True, "run"), (False, "other")):
        r = got[name]
        assert [r.aligned, r.insertions, r.deletions, r.inserted, r.deleted] == want[side]
        assert r.event_rate == pytest.approx((r.insertions + r.deletions) * 1e6 / r.aligned)
    assert got["run"].enrichment == pytest.approx(got["run"].event_rate / got["other"].event_rate)
    known = spark.createDataFrame([("a", 8)], "contig string, pos long")
    left = {r.context: r for r in alignments.indels_in_runs(reads, ["read"], blocks(spark, contigs, 5), 5, least=6, known=known, pad=2).collect()}
    assert sum(r.excluded for r in left.values()) == 2
    assert sum(r.insertions + r.deletions for r in left.values()) == sum(want[s][1] + want[s][2] for s in want) - 2
    assert alignments.indels_in_runs(reads.where("read < 0"), ["read"], blocks(spark, contigs, 5), 5).collect() == []


def search(t, p, k):
    row, out = list(range(len(p) + 1)), []
    for j, c in enumerate(t, 1):
        new = [0]
        for i in range(1, len(p) + 1):
            new.append(min(row[i - 1] + (p[i - 1] != c), row[i] + 1, new[i - 1] + 1))
        row = new
        if row[-1] <= k:
            out.append((j, row[-1]))
    return out


@pytest.mark.parametrize("pattern,edits", [("ACGTACGTTGCA", 2), ("A", 0), ("ACGT" * 15, 6)])
def test_approximate_search(spark, pattern, edits):
    r = random.Random(1)
    texts = ["".join(r.choice("ACGT") for _ in range(r.randrange(80))) for _ in range(20)] + ["", pattern, pattern[1:] + pattern]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", approximate_hits(F.col("t"), pattern, edits).alias("h")).orderBy("i").collect()
    assert [[tuple(h) for h in r.h] for r in got] == [search(t, pattern, edits) for t in texts]
    with pytest.raises(ValueError):
        approximate_hits(F.col("t"), "A" * 61, 1)


def test_search_in_batches_of_like_length(monkeypatch):
    """texts of all lengths in several steps, patterns of several lengths at once."""
    from quern.functions import search as batches

    monkeypatch.setattr(batches, "CELLS", 64)
    r = random.Random(2)
    texts = ["".join(r.choice("ACGTé") for _ in range(r.randrange(90))) for _ in range(30)] + [None, ""]
    patterns = ["ACGT", "GGATTACAG", "T"]
    got = dict(batches.hits_in(texts, patterns, 1))
    assert got == {i: [search(t, p, 1) for p in patterns] for i, t in enumerate(texts) if t is not None}


ADAPTERS = ["AAAACCCCTTGA", "GGATTACAGATC", "TTGCGCAACGGT"]


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_adapters_and_grammar(spark):
    whole = ADAPTERS[0] + "CTCTC" + ADAPTERS[1] + "GAGAGAG" + ADAPTERS[2]
    reads = [("complete", whole), ("turned", rc(whole)), ("edit", whole.replace("GATTACA", "GATACA")), ("partial", whole[:30]), ("broken", ADAPTERS[0] + "CTC" + ADAPTERS[2]), ("none", "CTCTCTCT"), ("mixed", ADAPTERS[0] + "CT" + rc(ADAPTERS[1])), ("empty", ""), ("null", None)]
    d = spark.createDataFrame(reads, "name string, read string").withColumn("hits", adapters.adapter_hits(F.col("read"), ADAPTERS, 1))
    got = {r.name: r.g for r in d.select("name", adapters.grammar(F.col("hits"), 2).alias("g")).collect()}
    assert {k: g and (g.grammar, g.segments, g.verdict) for k, g in got.items()} == {
        "complete": ("0+1+2+", 2, "complete"), "turned": ("2-1-0-", 2, "complete"), "edit": ("0+1+2+", 2, "complete"), "partial": ("0+1+", 1, "partial"),
        "broken": ("0+2+", 0, "broken"), "none": ("", 0, "none"), "mixed": ("0+1-", 0, "broken"), "empty": ("", 0, "none"), "null": None}
    cut = adapters.segments(d, ["name"], "read", "hits", [12] * 3).collect()
    by = {(r.name, r.segment): r.sequence for r in cut}
    assert by["complete", 0] == by["turned", 0] == "CTCTC" and by["complete", 1] == by["turned", 1] == by["edit", 1] == "GAGAGAG" and not any(k[0] in ("broken", "mixed") for k in by)


def test_segments_beside_overlapping_chance_hits(spark):
    a = ["GCCACACGCCCC", "GAATTCGGCGCG", "CCTAATTGGTGA"]
    read = a[0] + "TCGCGCGCC" + a[1] + "TCTCCGC" + a[2]  # rc(a[1]) ends within a[1], whose first letters are their own complement
    d = spark.createDataFrame([("on", read), ("back", rc(read))], "name string, read string").withColumn("hits", adapters.adapter_hits(F.col("read"), a, 0))
    assert [r.n for r in d.select(F.size("hits").alias("n")).collect()] == [4, 4]
    cut = sorted(map(tuple, adapters.segments(d, ["name"], "read", "hits", [12] * 3).collect()))
    assert cut == [(n, i, s) for n in ("back", "on") for i, s in enumerate(["TCGCGCGCC", "TCTCCGC"])]
    read = a[0] + "TCTC" + a[1] + "CCACACGCC" + a[2]  # a[0] again, over the ends of a[1] and a[2]
    d = spark.createDataFrame([("on", read)], "name string, read string").withColumn("hits", adapters.adapter_hits(F.col("read"), a, 0))
    assert sorted(map(tuple, adapters.segments(d, ["name"], "read", "hits", [12] * 3).collect())) == [("on", 0, "TCTC"), ("on", 1, "CCACACGCC")]


def test_consensus_and_yield(spark):
    seen = [("0", "ACGT")] * 3 + [("0", "ACGA")] + [("0", "ACG")] * 3 + [("1", "TT"), ("1", "AT"), ("1", ""), ("1", None)]
    got = {r.label: tuple(r)[1:] for r in adapters.consensus(spark.createDataFrame(seen, "label string, seq string")).collect()}
    assert got == {"0": ("ACGT", 4, 4, 0.75), "1": ("AT", 2, 2, 0.5)}
    found = spark.createDataFrame([(z, i) for z, n in enumerate([5, 2, 3, 3, 1]) for i in range(n)], "zmw int, di int")
    assert sorted(map(tuple, adapters.array_yield(found, "zmw", "zmw").collect())) == [(2, 1, 1 / 3), (3, 2, 2 / 3)]


def test_contents_go_over_bytes_once():
    b = bytes.fromhex("82a161" "93" "01" "e0" "cb3ff8000000000000" "cb40f86a0000000000" "d1ff00")  # {a: [1, -32, 1.5], 1e5: -256}
    assert mp.contents(b) == {"whole": True, "values": [
        {"path": "", "kind": "map", "text": "2", "number": None}, {"path": "a", "kind": "array", "text": "3", "number": None},
        {"path": "a.0", "kind": "int", "text": "1", "number": 1.0}, {"path": "a.1", "kind": "int", "text": "-32", "number": -32.0}, {"path": "a.2", "kind": "float", "text": None, "number": 1.5},
        {"path": "100000.0", "kind": "int", "text": "-256", "number": -256.0}]}
    assert not mp.contents(b[:-1])["whole"] and len(mp.contents(b[:-1])["values"]) == 5
    long = bytes([0xDD]) + (300_000).to_bytes(4) + bytes(300_000)
    assert len(mp.contents(long)["values"]) == 300_001


def test_told_adapters(spark):
    side = lambda label, seq: mp.pack_map(x=mp.pack_int(F.lit(1)), label=mp.pack_text(F.lit(label)), seq=mp.pack_text(F.lit(seq)))
    whole = mp.packed(mp.pack_map(left=side("0", "ACG"), right=side("1", "TTT")))
    d = spark.range(3).select("id", F.when(F.col("id") == 0, whole).when(F.col("id") == 1, F.substring(whole, F.lit(1), F.octet_length(whole) - 2)).alias("tag"))
    assert sorted(map(tuple, adapters.told_adapters(d, ["id"], "tag").collect())) == [(0, "0", "ACG"), (0, "1", "TTT"), (1, "0", "ACG")]


def test_phase_by_containment(spark):
    r = random.Random(5)
    h0 = "".join(r.choice("ACGT") for _ in range(300))
    h1 = h0[:100] + "".join(r.choice("ACGT") for _ in range(80)) + h0[180:]
    sides = [("x", 0, h0), ("x", 1, h1), ("same", 0, h0), ("same", 1, h0), ("one", 0, h0), ("one", 1, h1)]
    alleles = [("x", "ok", 0, h0[90:200]), ("x", "turned", 1, rc(h1[90:200])), ("x", "wrong", 0, h1[90:200]), ("x", "either", 0, h1[90:200]), ("x", "either", 1, h1[90:200]), ("x", "shared", 0, h0[200:290]), ("x", "gone", 0, None), ("x", "short", 0, "ACG"), ("same", "a", 0, h0[:50]), ("same", "b", 1, h0[50:90]), ("one", "only", 0, h0[:90]), ("nowhere", "a", 0, h0), ("nowhere", "b", 0, h1)]
    got = phasing.phase_by_containment(spark.createDataFrame(alleles, "locus string, allele string, declared int, seq string"), spark.createDataFrame(sides, "locus string, hap int, seq string"), 15)
    by = {(x.locus, x.allele): (x.declared, x.measured, x.status) for x in got.collect()}
    assert by == {("x", "ok"): ("0", 0, "ok"), ("x", "turned"): ("1", 1, "ok"), ("x", "wrong"): ("0", 1, "INVERTED"), ("x", "either"): ("0/1", 1, "ok"), ("x", "shared"): ("0", None, "indeterminate"), ("x", "gone"): ("0", None, "no sequence"), ("x", "short"): ("0", None, "indeterminate"), ("same", "a"): ("0", None, "no allelic difference"), ("same", "b"): ("1", None, "no allelic difference"), ("one", "only"): ("0", None, "homozygous"), ("nowhere", "a"): ("0", None, "indeterminate"), ("nowhere", "b"): ("0", None, "indeterminate")}


def test_phase_by_containment_broadcasts_no_kmers(spark):
    alleles = spark.createDataFrame([("x", "a", 0, "ACGTTGCA"), ("x", "b", 1, "ACGTAGCA")], "locus string, allele string, declared int, seq string")
    sides = spark.createDataFrame([("x", 0, "ACGTTGCA"), ("x", 1, "ACGTAGCA")], "locus string, hap int, seq string")
    assert "Broadcast" not in phasing.phase_by_containment(alleles, sides, 5)._jdf.queryExecution().executedPlan().toString()


EDITS = "contig string, hap int, start long, ref string, alt string"


def test_graft_records(spark):
    b = blocks(spark, {"a": "ACGTACGTACGTACGTACGT"}, 6)
    edits = [("a", 0, 2, "G", "T"), ("a", 1, 5, "CG", ""), ("a", 0, 7, "", "TT"), ("a", 0, 12, "A", "C"), ("a", 1, 12, "A", "C"), ("a", 0, 15, "T", "T"), ("a", 1, 17, "C", "G"), ("a", 1, 18, "G", "A"), ("a", 0, None, "A", "C"), ("b", 0, 3, "A", "C"), ("a", 0, 10, "g", "a")]
    got = phasing.graft_records(spark.createDataFrame(edits, EDITS), b, 6).collect()
    assert sorted((r.pos, r.ref, r.alts, r.gt0, r.gt1) for r in got) == [
        (3, "G", ["T"], 1, 0), (5, "ACGT", ["ACGTTT", "AT"], 1, 2), (11, "G", ["A"], 1, 0), (13, "A", ["C"], 1, 1), (18, "CG", ["GA"], 0, 1)]


def test_graft_records_refuse_wrong_edits(spark):
    b = blocks(spark, {"a": "ACGTACGT"}, 4)
    with pytest.raises(Exception, match="differs from the reference"):
        phasing.graft_records(spark.createDataFrame([("a", 0, 2, "C", "T")], EDITS), b, 4).collect()
    with pytest.raises(Exception, match="no anchor"):
        phasing.graft_records(spark.createDataFrame([("a", 0, 0, "A", "")], EDITS), b, 4).collect()
    assert [tuple(r)[1:3] for r in phasing.graft_records(spark.createDataFrame([("a", 0, 0, "A", "C")], EDITS), b, 4).collect()] == [(1, "A")]


def test_signed_components(spark):
    r = random.Random(2)
    n = 60
    side = [r.random() < 0.5 for _ in range(2 * n)]
    order = list(range(n))
    r.shuffle(order)
    edges = [(a, b, side[a] != side[b]) for a, b in zip(order, order[1:])]  # a long chain
    edges += [(n + a, n + b, side[n + a] != side[n + b]) for a in range(n) for b in r.sample(range(n), 2) if a != b]
    edges += [(1000, 1001, True), (1001, 1002, True), (1002, 1000, True), (5000, 5000, True), (None, 3, False)]
    got = {x.node: x for x in phasing.signed_components(spark.createDataFrame(edges, "a long, b long, opposite boolean")).collect()}
    assert all(got[i].root == 0 and got[i].parity == (side[i] != side[0]) and got[i].conflicts == 0 for i in range(n))
    seen, todo, near = set(), [], {}
    for a, b, s in edges[n - 1 : -5]:
        near.setdefault(a, []).append((b, s))
        near.setdefault(b, []).append((a, s))
    for start in sorted(near):
        if start in seen:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                assert got[x].root == start and got[x].parity == (side[x] != side[start])
                todo += [y for y, _ in near[x]]
    assert {got[i].root for i in (1000, 1001, 1002)} == {1000} and got[1000].conflicts == 1 and 5000 not in got


def test_combined_phase(spark):
    rec = "chrom string, pos long, ref string, alt string, gt0 int, gt1 int, phased boolean, ps long"
    rows = [
        ("c", 1, "A", "T", 0, 1, True, 1), ("c", 2, "A", "T", 0, 1, True, 1), ("c", 3, "A", "T", 1, 0, True, 1), ("c", 4, "A", "T", 0, 1, True, 1),  # block 1 is turned, two votes to one
        ("c", 11, "A", "T", 0, 1, True, 2), ("c", 21, "A", "T", 0, 1, True, 3),  # 2 as 1, 3 opposite to 2
        ("c", 31, "A", "T", 0, 1, True, 9), ("c", 32, "A", "T", 1, 0, True, 10), ("c", 41, "A", "T", 0, 1, True, 50), ("c", 42, "A", "T", 0, 1, False, None),
        ("c", 51, "A", "T", 1, 1, False, None), ("c", 61, "A", "T", None, 1, False, None), ("x", 5, "A", "T", 0, 1, True, 1), ("x", 6, "A", "T", 1, 1, True, 1), ("x", 50, "A", "T", 1, 1, True, 1),
    ]
    panel = [("c", 1, "A", "T", 1, 0), ("c", 2, "A", "T", 1, 0), ("c", 3, "A", "T", 1, 0)]
    links = [("c", 1, 2, False), ("c", 2, 3, True), ("c", 9, 10, True)]
    lone = [("x", 0, 10)]
    d = phasing.combined_phase(spark.createDataFrame(rows, rec), spark.createDataFrame(panel, "chrom string, pos long, ref string, alt string, h0 int, h1 int"), spark.createDataFrame(links, "chrom string, a long, b long, opposite boolean"), spark.createDataFrame(lone, "chrom string, start long, end long"), 7)
    got = {(r.chrom, r.pos): (r.gt0, r.gt1, r.source) for r in d.collect()}
    assert len(got) == len(rows)
    assert [got["c", p] for p in (1, 2, 3)] == [(1, 0, "panel")] * 3
    assert got["c", 4] == (1, 0, "block") and got["c", 11] == (1, 0, "linked") and got["c", 21] == (0, 1, "linked")
    assert got["c", 31][2] == got["c", 32][2] == "component" and got["c", 31][0] == got["c", 32][0]
    assert got["c", 41][2] == got["c", 42][2] == "random" and got["c", 51] == (1, 1, "hom") and got["c", 61] == (None, 1, None)
    assert got["x", 5] == (0, None, "haploid") and got["x", 6] == (1, None, "haploid") and got["x", 50] == (1, 1, "hom")


def test_background_by_channel(spark):
    r = random.Random(8)
    contigs = {"a": "".join(r.choice("ACGT") for _ in range(900)), "b": "ACGN" * 30, "c": "NNNN"}
    channels = [(f"{x}[C>{y}]{z}", f"{x}C{z}", "C", y, float(1 + (ord(x) + ord(y)) % 3)) for x in "ACGT" for z in "ACGT" for y in "AGT"]
    ch = spark.createDataFrame(channels, "channel string, context string, ref string, alt string, weight double")
    clones = spark.createDataFrame([("T", 0.6), ("x", 0.4)], "clone string, share double")
    lone = spark.createDataFrame([("a", 100, 160), ("a", 150, 300), ("a", 890, 990)], "contig string, start long, end long")
    for width in (7, 64):
        b = blocks(spark, contigs, width)
        want = {(x.contig, x.channel): x.n for x in passengers.channel_counts(b, ch.select("channel", "weight"), 60_000).collect()}
        assert {c: sum(n for (k, _), n in want.items() if k == c) for c in contigs} == {"a": 54, "b": 5, "c": 0}
        got = passengers.background(b, ch, clones, 60_000, 3, width, lone).collect()
        assert len({(x.contig, x.pos) for x in got}) == len(got)
        assert {x.clone for x in got} == {"T", "x"}
        for x in got:
            s, p = contigs[x.contig], x.pos - 1
            assert s[p - 1 : p + 2] == x.context and x.ref == s[p] and not (x.contig == "a" and (100 <= p < 300 or p >= 890))
            own = (x.context, x.ref, x.alt) if x.ref in "CT" else (rc(x.context), rc(x.ref), rc(x.alt))
            assert x.channel == f"{own[0][0]}[{own[1]}>{own[2]}]{own[0][2]}"
    b = blocks(spark, {"a": contigs["a"]}, 64)
    want = {x.channel: x.n for x in passengers.channel_counts(b, ch.select("channel", "weight"), 20_000).collect() if x.n}
    seen: dict[str, int] = {}
    for x in passengers.background(b, ch, clones, 20_000, 3, 64).collect():
        seen[x.channel] = seen.get(x.channel, 0) + 1
    assert seen == want  # no more draws than places: every channel has its number


def test_more_draws_than_places(spark):
    ch = spark.createDataFrame([("A[C>A]G", "ACG", "C", "A", 1.0), ("A[C>T]G", "ACG", "C", "T", 1.0)], "channel string, context string, ref string, alt string, weight double")
    clones = spark.createDataFrame([("T", 1.0)], "clone string, share double")
    got = passengers.background(blocks(spark, {"a": "ACGTTTACGTTTACG"}, 4), ch, clones, 1e6, 3, 4).collect()
    # The other strand has the context too; all places go to the first channel.
    assert sorted(x.pos for x in got) == [2, 3, 8, 9, 14] and {x.channel for x in got} == {"A[C>A]G"}


def test_sidecars(spark, tmp_path):
    lines = [("a", '{"new": {"n": 5}, "old": 9, "os": "x"}'), ("a", '{"old": 7, "os": "y"}'), ("a", "{broken"), ("a", ""), ("b", '[{"new": 1}]'), ("b", '{"old": "text"}'), ("c", "null")]
    for k in "abc":
        (tmp_path / f"kind={k}").mkdir()
        (tmp_path / f"kind={k}" / "1.json").write_text("".join(v + "\n" for x, v in lines if x == k))
    got = readers.sidecar_totals(spark, f"file://{tmp_path}", "kind", {"n": ["$.new.n", "$.old"]}, {"systems": "$.os"})
    size = {k: sum(len(v) + 1 for x, v in lines if x == k) for k in "abc"}
    assert sorted((r.kind, r.sidecars, r.read_, r.n, r.systems, r.bytes) for r in got.collect()) == [("a", 4, 2, 12, 2, size["a"]), ("b", 2, 2, 0, 0, size["b"]), ("c", 1, 1, 0, 0, size["c"])]


SAMPLES = "label string, method string, normal boolean, rna boolean, full string, subset string, platform string"


def test_manifest_and_its_guard(spark):
    datasets = spark.createDataFrame([("A", "x,y", "1"), ("B", "z", "2")], "dataset string, alleles string, group string")
    rows = [("wes_tumor", "WES", False, False, "{d}_tumor_wes", "{d}_sub_tumor_wes", "Illumina"), ("gex", "scRNA-Seq", False, True, "{d}-GEX_S1", "{d}-sub-GEX_S1", "ONT")]
    made = {v: bundles.manifest(datasets, spark.createDataFrame(rows, SAMPLES), ("full", "sub"), v) for v in ("", "v1")}
    got = {(r.dataset, r.run_name): (r.file_prefix, r.read_type, r.sample_type) for r in bundles.guarded(made["v1"], made[""]).collect()}
    assert len(got) == 8 and got["A", "ad-wes-tumor"] == ("A_v1_tumor_wes", "short-read", "tumor") and got["B-sub", "ar-gex"] == ("B-v1-sub-GEX_S1", "long-read", "tumor")
    # A version at the end would leave the old prefix in front of the new one.
    later = made[""].withColumn("file_prefix", F.concat("file_prefix", F.lit("_v1")))
    with pytest.raises(ValueError, match="A_tumor_wes begins A_tumor_wes_v1"):
        bundles.guarded(later.where("patient = 'A' and dataset = 'A' and run_name like '%wes%'"), made[""])
    bad = spark.createDataFrame([("x", "WES", False, False, "tumor", "tumor", "ONT")], SAMPLES)
    with pytest.raises(Exception, match="no dataset and separator"):
        bundles.manifest(datasets, bad, ("full",), "v1").collect()


def test_unresolved_rows_end_the_job(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    value = sets.resolved_or_error(F.col("v"), F.col("k").cast("string"))
    assert d.where("k = 1").select(value.alias("v")).first().v == "a"
    with pytest.raises(Exception, match="not resolved: 2"):
        d.select(value).collect()


def test_coding_texts_of_asked_genes_alone(spark):
    t = spark.createDataFrame([("asked", "c", "+", [(0, 6)]), ("other", "c", "+", [(0, 6)])], "gene string, contig string, strand string, exons array<struct<start:long,end:long>>")
    spec = "event string, gene string, first long, last long, haplotype string, label string, expect_codon long, expect_aa string, expect_effect string"
    d = spikeins.resolve(spark.createDataFrame([("e", "asked", 4, 4, "0", None, None, None, None)], spec), t, blocks(spark, {"c": "ATGAAATT"}, 4), 4, spark.createDataFrame([], "contig string, start long, end long"), spark.createDataFrame([], "label string, cn0 int, cn1 int"))
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and [(r.codon, r.wt_aa, r.problems) for r in d.collect()] == [(2, "K", "")]


def test_spike_ins(spark):
    r = random.Random(6)
    seq = "".join(r.choice("ACGT") for _ in range(30)) + "ATGAAAAAAGCC" + "TTTT" + "GGCCCATGA" + "".join(r.choice("ACGT") for _ in range(30))
    transcripts = [("plus", "c", "+", [(30, 42), (46, 55)]), ("minus", "c", "-", [(30, 42), (46, 55)])]
    t = spark.createDataFrame(transcripts, "gene string, contig string, strand string, exons array<struct<start:long,end:long>>")
    spec = "event string, gene string, first long, last long, haplotype string, label string, expect_codon long, expect_aa string, expect_effect string"
    rows = [
        ("good", "plus", 9, 9, "1", None, 3, "K", "frameshift"), ("kept", "plus", 4, 6, "retained", "one", 2, "K", "inframe_deletion"), ("both", "plus", 4, 4, "retained", "two", None, None, None),
        ("wrong", "plus", 4, 4, "0", None, 3, "M", "missense"), ("intron", "plus", 12, 13, "0", None, None, None, None), ("past", "plus", 20, 22, "0", None, None, None, None),
        ("none", "other", 1, 1, "0", None, None, None, None), ("turned", "minus", 2, 2, "0", None, 1, "S", None), ("there", "plus", 16, 17, "0", None, None, None, None),
    ]
    b = blocks(spark, {"c": seq}, 8)
    germline = spark.createDataFrame([("c", 47, 51)], "contig string, start long, end long")
    losses = spark.createDataFrame([("one", 0, 2), ("two", 1, 1)], "label string, cn0 int, cn1 int")
    got = {x.event: x for x in spikeins.resolve(spark.createDataFrame(rows, spec), t, b, 8, germline, losses).collect()}
    assert {k: x.problems for k, x in got.items()} == {
        "good": "", "kept": "", "both": "no single haplotype", "wrong": "other codon,other residue,other consequence", "intron": "spans an intron", "past": "past the coding sequence", "none": "no transcript", "turned": "", "there": "a change is there"}
    # The ninth coding letter is the last of six A: written as far left as it goes.
    assert (got["good"].pos, got["good"].ref, got["good"].alt) == (33, "GA", "G") and seq[32:34] == "GA"
    assert got["kept"].haplotype == 1 and got["kept"].ref == "GAAA" and got["good"].haplotype == 1 and got["intron"].pos is None
    for x in got.values():
        if x.pos is not None:
            assert seq[x.pos - 1 : x.pos - 1 + len(x.ref)] == x.ref
