"""Steps whose memory or time in one task grew faster than their input."""

import random

from pyspark.sql import functions as F

from quern.operators import genome, passengers
from quern.sources import readers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def blocks(spark, contigs: dict[str, str], width: int):
    rows = [(c, i // width, s[i : i + width]) for c, s in contigs.items() for i in range(0, len(s), width)]
    return spark.createDataFrame(rows, "contig string, block long, seq string")


def test_contexts_are_counted_within_their_block(spark):
    """No letter is a row, and no task holds a table of all blocks' contexts."""
    r = random.Random(5)
    contigs = {"a": "".join(r.choice("ACGTN") for _ in range(300)), "é": "acgÉtacgta"}
    turn = str.maketrans("ACGT", "TGCA")
    for width in (7, 64):
        got = passengers.context_index(blocks(spark, contigs, width))
        assert "Aggregate" not in plan(got) and "Generate" not in plan(got)
        want: dict[tuple, int] = {}
        for c, s in contigs.items():
            s = s.upper()
            for i in range(1, len(s) - 1):
                x = s[i - 1 : i + 2]
                if set(x) <= set("ACGT"):
                    k = (c, x if x[1] in "CT" else x[::-1].translate(turn), i // width)
                    want[k] = want.get(k, 0) + 1
        rows = {(x.contig, x.context, x.block): x for x in got.collect()}
        assert {k: x["count"] for k, x in rows.items()} == want
        assert all(x.before == sum(n for (c, t, b), n in want.items() if (c, t) == k[:2] and b < k[2]) for k, x in rows.items())


def test_conflicts_are_counted_in_parts_of_bounded_rows(spark, tmp_path, monkeypatch):
    """The number of parts follows the number of lines, and no scanning task counts pairs before."""
    from quern.plans import aggregate_plans, registry

    monkeypatch.setattr(aggregate_plans, "PART_ROWS", 10)
    lines = [(k, (k * 7 + i) % 5) for k in range(20) for i in range(k % 4)] + [(99, 0), (99, 1), (None, 1), (None, 2), (3, 77)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(s, s // 2) for s in range(5)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k,) for k in [*range(20), 3]], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.QUERIES["a26_conflicts"](spark, str(tmp_path))
    p = plan(got)
    nations = {k: {s // 2 for x, s in lines if x == k and s < 5} for k in range(20)}
    assert sorted((r.o_orderkey, r.n) for r in got.collect()) == sorted((k, len(n)) for k, n in nations.items() if len(n) > 1)
    assert f", {len(lines) // 10 + 1}), REPARTITION_BY_NUM" in p
    assert "Aggregate" not in p[p.index("REPARTITION_BY_NUM") :]


def test_junctions_look_at_each_text_once(spark):
    """Long texts: codons up to the first stop are one match; a stop in the left part rules out its cuts."""
    rows = [(1, ["ATG" * 5000, "AAA"], ["CCC", "GGG" * 5000]), (2, ["ATG", "TAA", "CCC", "GGG"], ["A", "CTAGCC", "CCCCCC"]), (3, ["ATGT", "AA"], ["AA", "AACCC"])]
    d = spark.createDataFrame(rows, "k int, left array<string>, right array<string>")
    got = genome.junctions(d, ["k"], True, 1, 34)
    assert "transform(sequence" not in plan(got)
    assert {r.k: (r.options, r.i, r.j, r.protein_len) for r in got.collect()} == {1: (1, 1, 1, 10000), 2: (2, 1, 2, 3)}
    out = {r.k: r.protein_len for r in genome.junctions(d, ["k"], False, 1, 34).collect()}
    assert out == {}


def test_letters_of_parts_are_merged_not_broadcast(spark):
    from quern.plans import registry

    registry.load()
    assert "SortMergeJoin [l_partkey" in plan(registry.QUERIES["d13_junction_search"](spark, "/root/testdata/sf0.001"))


def test_letters_of_grafts_are_merged_not_broadcast(spark):
    """Neither an edit's part nor the blocks under a record go through the driver."""
    from quern.plans import registry

    registry.load()
    p = plan(registry.QUERIES["d28_graft_alleles"](spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin [l_partkey" not in p and "BroadcastHashJoin [__on" not in p
    assert "SortMergeJoin [l_partkey" in p and "SortMergeJoin [__on" in p


def test_slices_ask_for_bands_by_distinct_places(spark, monkeypatch):
    """Slices of many sequences at one place are one question, so a contig's slices never meet."""
    asked, asof_join = [], genome.asof_join

    def counted(left, *args, **kwargs):
        asked.append(left.count())
        return asof_join(left, *args, **kwargs)

    monkeypatch.setattr(genome, "asof_join", counted)
    rows = [(k, 1, 1, 20, "c", 101, 120, "+", False) for k in range(50)]
    pieces = spark.createDataFrame(rows, "k int, ordinal int, d_start long, d_end long, contig string, r_start long, r_end long, strand string, inserted boolean")
    cuts = spark.createDataFrame([("c", 90), ("c", 111)], "contig string, pos long")
    got = genome.uniform_slices(pieces, cuts, ["k"], 4).collect()
    assert sorted((r.k, r.start, r.end, r.band) for r in got) == sorted(x for k in range(50) for x in ((k, 1, 10, 90), (k, 11, 20, 111)))
    assert asked == [2]


def test_lines_are_numbered_without_sorting_them(spark, tmp_path):
    lines = [f"line {i}" for i in range(3000)]
    for k in range(3):
        (tmp_path / f"part-{k}").write_text("\n".join(lines[k * 1000 : k * 1000 + 1000]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several blocks a file
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        got = readers.ordered_lines(spark, str(tmp_path))
        p = plan(got)
        assert p.count("row_number") == 0 and p.count("Window [") == 1  # over blocks, not lines
        assert sorted((r.ordinal, r.value) for r in got.collect()) == list(enumerate(lines))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_alignment_lines_are_dealt_before_they_are_made(spark):
    from quern.plans import registry

    registry.load()
    assert "RoundRobinPartitioning" in plan(registry.QUERIES["s19_alignment_edits"](spark, "/root/testdata/sf0.001"))


def test_context_of_sites_is_looked_up_by_spots(spark):
    """A run's expression names its letters once; a site costs no join of its own, and piled-up spans are one."""
    run = genome.run_length(F.substring("text", 3, 20), F.col("at")).alias("run")
    text = spark.range(1).select(F.lit("ACGT").alias("text"), F.lit(1).alias("at")).select(run)._jdf.queryExecution().analyzed().toString()
    assert text.count("substring(text") <= 3
    r = random.Random(8)
    seq = {"a": "".join(r.choice("ACGGG") for _ in range(203)), "b": "CCCC"}
    sites = [(c, p) for c in ("a", "b", "d") for p in r.sample(range(-20, 300), 120)]
    hets = [("a", p) for p in r.sample(range(210), 60)] + [("a", None)]
    spans = {k: [("a", s, s + r.choice((0, 3, 40, 150))) for s in r.choices(range(-10, 200), k=25)] + [("b", -500, 900), ("b", -400, 700)] for k in ("cap", "rep", "dup", "cds")}
    rows = [(*x, f"n{i % 7}") for i, x in enumerate(spans["rep"])]
    frame = lambda d: spark.createDataFrame(d, "contig string, start long, `end` long")
    places = lambda d: spark.createDataFrame(d, "contig string, pos long")
    got = genome.context_features(places(sites), blocks(spark, seq, 7), 7, places(hets), frame(spans["cap"]), spark.createDataFrame(rows, "contig string, start long, `end` long, name string"), frame(spans["dup"]), frame(spans["cds"])).collect()
    assert len(got) == len(sites)
    for x in got:
        on = lambda d: [s for s in d if s[0] == x.contig and s[1] <= x.pos < s[2]]  # noqa: B023, E731
        edge = lambda d: min((min(x.pos - s, e - 1 - x.pos) for _, s, e in on(d)), default=None)  # noqa: B023, E731
        near = [abs(p - x.pos) for c, p in hets if c == x.contig and p is not None and 0 < abs(p - x.pos) <= 30]
        assert (x.hets_near, x.nearest_het) == (len(near), min(near, default=None))
        assert (x.capture_edge, x.on_target, x.cds_edge, x.segdup) == (edge(spans["cap"]), bool(on(spans["cap"])), edge(spans["cds"]), bool(on(spans["dup"])))
        assert x.repeat == min((s[1:] for s in on(rows)), default=(None,))[-1]
        w = seq.get(x.contig, "")[max(x.pos - 50, 0) : max(x.pos + 50, 0)]
        assert x.gc == (round(sum(c in "GC" for c in w) / len(w) + 1e-9, 3) if w else None) and (x.homopolymer_run is None) == (not w)


def test_operations_are_placed_without_moving_reads(spark):
    """Places are summed row by row, over batches' cuts too; spans that touch one spot of 64 places don't meet in pairs."""
    import re

    from quern.operators import alignments

    r = random.Random(2)
    texts = ["".join(f"{r.randrange(30)}{r.choice('MIDNSHP=XZé')}" for _ in range(r.choice((0, 3, 60)))) for _ in range(300)] + ["*", None, "M3", "99" * 6 + "D1M"]
    rows = [(i % 3, "c", 7 * i - 50, x) for i, x in enumerate(texts)]
    reads = spark.createDataFrame(rows, "flag int, contig string, pos long, cigar string")
    ops = alignments.operations(reads, ["flag"])
    assert "Window" not in plan(ops) and "Exchange" not in plan(ops)
    want = []
    for flag, c, pos, x in rows:
        found = [(int(n), o) for n, o in re.findall(r"([0-9]+)([MIDNSHP=X])", x or "")]
        span = [n * (o in "MDN=X") for n, o in found]
        want += [(flag, c, pos, i, o, n, pos + sum(span[:i]), sum(span)) for i, (n, o) in enumerate(found)]
    assert sorted(map(tuple, ops.collect())) == sorted(want)
    text = "".join(r.choice("AAC") for _ in range(700))
    got = alignments.indels_in_runs(reads.where(F.length("cigar") < 300), [], blocks(spark, {"c": text}, 9), 9, ["flag"], least=70)
    assert plan(got).count("SortMergeJoin") + plan(got).count("ShuffledHashJoin") + plan(got).count("BroadcastHashJoin") <= 2 and "Window [sum(" not in plan(got)
    text = "A" * 200 + text
    got = alignments.indels_in_runs(reads, [], blocks(spark, {"c": text}, 9), 9, ["flag"], least=70).where("context = 'run'").collect()
    inside = {p for m in re.finditer(r"A{70,}|C{70,}", text) for p in range(m.start(), m.end())}
    for x in got:
        assert x.aligned == sum(p in inside for f, _, _, _, o, n, at, _ in want if f == x.flag and o in "M=X" for p in range(at, at + min(n, 10**6)))
    assert len(got) == 3


def test_distal_windows_are_drawn_in_the_rows_of_contigs(spark):
    """No draw is a row before it is known to be free; spans over several bins, touching ones and bare contigs."""
    from quern.operators.sampling import uniform

    contigs = spark.createDataFrame([("a", 5000), ("b", 3000), ("c", 100000)], "contig string, length long")
    spans = [("a", 900, 1000), ("a", 1001, 1400), ("a", 4000, 4010), ("c", 10, 60000), ("c", 70000, 70000), ("z", 1, 9)]
    got = genome.distal(contigs, spark.createDataFrame(spans, "contig string, start long, `end` long"), 6, 50, 100, 3, 20)
    assert "overlap" not in plan(got) and "row_number" not in plan(got) and "monotonically" not in plan(got)
    draws = contigs.select("contig", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("i"), "length")
    draws = draws.select("contig", "i", (1 + F.floor(uniform(3, "contig", "i") * (F.col("length") - 51))).cast("long").alias("s")).collect()
    want = []
    for c in "abc":
        free = [d.s for d in sorted(draws, key=lambda d: d.i) if d.contig == c and not any(x == c and max(1, s - 100) <= d.s + 50 and e + 100 >= d.s for x, s, e in spans)]
        want += [(c, s, s + 49) for s in free[:6]]
    assert sorted(map(tuple, got.collect())) == sorted(want)
