import random

import pytest
from pyspark.sql import functions as F

from quern.operators import hierarchy, intervals

SPANS = "k string, id int, start long, `end` long"


def spans(draw, n, top=200):
    out = []
    for i in range(n):
        s = draw.randrange(top)
        out.append((draw.choice("ab"), i, s, s + draw.choice([0, 1, 1, 5, 30, 150])))
    return out


@pytest.mark.parametrize("seed,width", [(1, 7), (2, 50), (3, 1000)])
def test_overlap_join(spark, seed, width):
    draw = random.Random(seed)
    a, b = spans(draw, 40), spans(draw, 40)
    got = intervals.overlap_join(spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS), ["k"], width)
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[3] > y[2] and x[2] < y[3] and x[2] < x[3] and y[2] < y[3])
    assert sorted((r.id, r.b_id) for r in got.collect()) == want


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_point_join(spark, how):
    draw = random.Random(4)
    b = spans(draw, 30)
    points = [(draw.choice("ab"), i, draw.randrange(220)) for i in range(60)]
    got = intervals.point_join(spark.createDataFrame(points, "k string, p int, pos long"), spark.createDataFrame(b, SPANS), ["k"], width=16, how=how).collect()
    hit = [(p[1], s[1]) for p in points for s in b if p[0] == s[0] and s[2] <= p[2] < s[3]]
    if how == "inner":
        assert sorted((r.p, r.id) for r in got) == sorted(hit)
    else:
        inside = {p for p, _ in hit}
        assert {r.p for r in got} == (inside if how == "left_semi" else {p[1] for p in points} - inside)


def test_boundaries(spark):
    one = spark.createDataFrame([("a", 0, 10, 11), ("a", 1, 11, 12), ("a", 2, 12, 12)], SPANS)
    points = spark.createDataFrame([("a", 10), ("a", 11), ("a", 12)], "k string, pos long")
    assert sorted((r.pos, r.id) for r in intervals.point_join(points, one, ["k"], width=1).collect()) == [(10, 0), (11, 1)]
    assert intervals.overlap_join(one, one, ["k"], 4).where("id < b_id").count() == 0
    empty = one.limit(0)
    assert intervals.overlap_join(one, empty, ["k"]).count() == 0 and intervals.islands(empty, ["k"]).count() == 0


@pytest.mark.parametrize("gap", [0, 3])
def test_islands(spark, gap):
    rows = [("a", 0, 0, 5), ("a", 1, 5, 6), ("a", 2, 8, 9), ("a", 3, 20, 30), ("a", 4, 21, 22), ("b", 5, 0, 1)]
    got = sorted(tuple(r) for r in intervals.islands(spark.createDataFrame(rows, SPANS), ["k"], gap=gap).collect())
    want = {0: [("a", 0, 6, 2), ("a", 8, 9, 1), ("a", 20, 30, 2), ("b", 0, 1, 1)], 3: [("a", 0, 9, 3), ("a", 20, 30, 2), ("b", 0, 1, 1)]}
    assert got == want[gap]


def test_greedy_keeps_first_and_reports_dropped(spark):
    rows = [("a", 0, 0, 5), ("a", 1, 4, 6), ("a", 2, 5, 9), ("a", 3, 8, 9), ("b", 4, 1, 2)]
    got = {r.id: r.kept for r in intervals.greedy(spark.createDataFrame(rows, SPANS), ["k"], "id").collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 4: True}


def test_elementary_depth_and_tiles(spark):
    df = spark.createDataFrame([("a", 0, 0, 10), ("a", 1, 5, 12)], SPANS)
    assert sorted((r.start, r.end, r.depth) for r in intervals.depth(df, ["k"]).collect()) == [(0, 5, 1), (5, 10, 2), (10, 12, 1)]
    assert sorted((r.start, r.end) for r in intervals.elementary(df, ["k"]).collect()) == [(0, 5), (5, 10), (10, 12)]
    tiles = intervals.tiles(df, 4).where("id = 0").select("tile_start", "tile_end").collect()
    assert sorted(map(tuple, tiles)) == [(0, 4), (4, 8), (8, 10)]


def test_asof(spark):
    left = spark.createDataFrame([("a", 5, "x"), ("a", 0, "y"), ("b", 9, "z")], "k string, pos long, n string")
    right = spark.createDataFrame([("a", 1, 10), ("a", 5, 50), ("c", 1, 7)], "k string, pos long, v long")
    assert {r.n: r.v for r in intervals.asof_join(left, right, ["k"], "pos", ["v"]).collect()} == {"x": 50, "y": None, "z": None}
    assert {r.n: r.v for r in intervals.asof_join(left, right, ["k"], "pos", ["v"], strict=True).collect()} == {"x": 10, "y": None, "z": None}


def test_plan_is_an_equi_join(spark):
    a = spark.range(10).select(F.lit("a").alias("k"), F.col("id").alias("start"), (F.col("id") + 5).alias("end"))
    plan = intervals.overlap_join(a, a, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_closure(spark):
    edges = [("A1", "A"), ("A", "T"), ("B", "T"), ("T", None), ("A2", "A1"), ("A3", "A2")]
    got = {tuple(r) for r in hierarchy.closure(spark.createDataFrame(edges, "node string, parent string")).collect()}
    assert ("T", "A3", 4) in got and ("A", "A3", 3) in got and ("B", "B", 0) in got and len(got) == 6 + 4 + 3 + 2 + 1 + 1
    with pytest.raises(ValueError):
        hierarchy.closure(spark.createDataFrame([("a", "b"), ("b", "a")], "node string, parent string"))


def test_exclusive_reports_negative(spark):
    rows = [("T", None, 1.0), ("A", "T", 0.7), ("B", "T", 0.6)]
    got = {r.node: r for r in hierarchy.exclusive(spark.createDataFrame(rows, "node string, parent string, share double")).collect()}
    assert not got["T"].ok and got["A"].ok and got["T"].exclusive == pytest.approx(-0.3)


@pytest.mark.parametrize("seed,width", [(5, 1), (6, 7), (7, 40)])
def test_bins_change_nothing(spark, seed, width):
    draw = random.Random(seed)
    rows = spans(draw, 80, 300) + [(None, 900 + i, 3 * i, 3 * i + 4) for i in range(5)] + [("a", 990, None, 5), ("b", 991, 5, None)]
    df = spark.createDataFrame(rows, SPANS)
    whole = [r for r in rows if r[2] is not None and r[3] is not None]
    got = lambda d: sorted(map(tuple, d.collect()), key=str)
    for gap in (0, 4):
        want = []
        for k in ("a", "b", None):
            for _, _, s, e in sorted((r for r in whole if r[0] == k), key=lambda r: (r[2], r[3])):
                if want and want[-1][0] == k and s - want[-1][2] <= gap:
                    want[-1] = (k, want[-1][1], max(want[-1][2], e), want[-1][3] + 1)
                else:
                    want.append((k, s, e, 1))
        assert got(intervals.islands(df, ["k"], gap=gap, width=width)) == sorted(want, key=str)
        more = intervals.islands(df, ["k"], gap=gap, width=width, least=F.min("id")).drop("least")
        assert got(more) == sorted(want, key=str)
    ordered = {k: sorted((r[2], r[3]) for r in whole if r[0] == k) for k in ("a", "b", None)}
    want = [(k, x[1], y[0]) for k, v in ordered.items() for x, y in zip(v, v[1:]) if y[0] > x[1]]
    assert got(intervals.gaps(df, ["k"], width=width)) == sorted(want, key=str)
    want = []
    for k, v in ordered.items():
        for i, (s, e) in enumerate(v):
            left = max(s - 9, v[i - 1][1] if i else s - 9)
            right = min(e + 9, v[i + 1][0] if i + 1 < len(v) else e + 9)
            want.append((k, s, e, min(left, s), max(right, e)))
    assert got(intervals.flanks(df, ["k"], 9, width=width).drop("id")) == sorted(want, key=str)
    want = []
    for k, v in ordered.items():
        cuts = sorted({p for x in v for p in x})
        want += [(k, x, y, sum(s <= x and e >= y for s, e in v)) for x, y in zip(cuts, cuts[1:])]
    assert got(intervals.depth(df, ["k"], width=width)) == sorted(want, key=str)
    assert got(intervals.elementary(df.where("start is not null and `end` is not null"), ["k"], width=width)) == sorted((w[:3] for w in want), key=str)
    kept = {}
    for k in ordered:
        last = None
        for s, e, i in sorted((r[2], r[3], r[1]) for r in whole if r[0] == k):
            kept[i] = last is None or s >= last
            last = e if kept[i] else last
    assert {r.id: r.kept for r in intervals.greedy(df, ["k"], "id", width=width).collect()} == kept


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_coalesce_and_asof_over_bins(spark, width):
    draw = random.Random(8)
    rows, at = [], 0
    for _ in range(60):
        at += draw.choice([0, 0, 0, 2])
        n = draw.choice([1, 3, 12])
        rows.append((draw.choice(["a", "a", "b"]), draw.choice(["x", "x", None, "y"]), at, at + n))
        at += n
    want = []
    for k in "ab":
        run = None
        for _, c, s, e in (r for r in rows if r[0] == k):
            if run and run[1] == c and run[3] == s:
                run = (k, c, run[2], e, run[4] + 1)
            else:
                want += [run] if run else []
                run = (k, c, s, e, 1)
        want.append(run)
    df = spark.createDataFrame(rows, "k string, c string, start long, `end` long")
    got = intervals.coalesce_equal(df, ["k"], ["c"], width=width).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)

    left = [(draw.choice(["a", "b", None]), draw.choice([None, *range(60)]), i) for i in range(50)]
    right = [(draw.choice(["a", None]), draw.choice([None, *range(0, 60, 3)]), draw.randrange(9)) for _ in range(25)]
    x, y = spark.createDataFrame(left, "k string, pos long, n int"), spark.createDataFrame(right, "k string, pos long, v int")
    for strict in (False, True):
        best = {}
        for k, p, n in left:
            of = [(q, v) for j, q, v in right if j == k and None not in (p, q) and (q < p or q == p and not strict)]
            best[n] = max(of)[1] if of else None
        assert {r.n: r.v for r in intervals.asof_join(x, y, ["k"], "pos", ["v"], strict, width).collect()} == best


def test_long_and_short_spans_make_few_rows(spark):
    """A span of 250 million places beside short ones: a few bins each, and the same pairs."""
    long = [("a", 0, 5, 250_000_005), ("a", 1, 900, 3_000_000), ("b", 2, 0, 250_000_000), ("a", 8, 7, 7), (None, 9, 0, 99)]
    short = [("a", 10 + i, i * 1_000_003, i * 1_000_003 + 1 + i % 3000) for i in range(200)] + [("b", 500, 249_999_999, 250_000_001), ("c", 501, 5, 6)]
    a, b = spark.createDataFrame(long, SPANS), spark.createDataFrame(short, SPANS)
    levels = a.select("id", F.size(intervals.bins(F.col("start"), F.col("end"), intervals.level(F.col("start"), F.col("end"), 1000), 1000)).alias("n")).collect()
    assert all(r.n is None or r.n <= intervals.SPREAD + 1 for r in levels)
    want = sorted((x[1], y[1]) for x in long for y in short if x[0] == y[0] and x[3] > y[2] and x[2] < y[3] and x[2] < x[3])
    for x, y, turned in ((a, b, False), (b, a, True)):
        got = intervals.overlap_join(x, y, ["k"])
        assert sorted((r.b_id, r.id) if turned else (r.id, r.b_id) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    points = spark.createDataFrame([(k, i, p) for i, (k, _, p, _) in enumerate(short)] + [("a", 900, None)], "k string, p int, pos long")
    inside = sorted((p, s[1]) for p, (k, _, at, _) in enumerate(short) for s in long if s[0] == k and s[2] <= at < s[3])
    for width, longest in ((1, None), (1000, None), (1_000_000, 5_000_000), (1000, 250_000_000)):  # the third one is too short: no row is lost
        assert sorted((r.p, r.id) for r in intervals.point_join(points, a, ["k"], width=width, longest=longest).collect()) == inside
        assert {r.p for r in intervals.point_join(points, a, ["k"], width=width, how="left_anti", longest=longest).collect()} == {900, *range(len(short))} - {p for p, _ in inside}
    assert intervals.point_join(points, a.limit(0), ["k"]).count() == 0 and intervals.point_join(points, a.limit(0), ["k"], how="left_anti").count() == 203
