import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quern.llm import near_dedup as nd
from quern.llm._graph import components, merged

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(pairs, threshold=0.8):
    """Class of each row by place, from all pairs."""
    sets = [shingles(t) or ("text", t or "") for _, t, _ in pairs]
    distinct = {}
    for s in sets:
        distinct.setdefault(frozenset(s) if isinstance(s, set) else s, len(distinct))
    keys = list(distinct)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(set)
    links = Counter()
    for i, s in enumerate(keys):
        if isinstance(s, frozenset):
            shared = Counter(j for x in s for j in index[x])
            for j, n in shared.items():
                if n >= threshold * (len(s) + len(keys[j]) - n):
                    root[find(i)] = find(j)
                    links[i] += 1
                    links[j] += 1
            for x in s:
                index[x].add(i)
    return [find(distinct[frozenset(s) if isinstance(s, set) else s]) for s in sets]


def check(got, pairs):
    where = defaultdict(list)
    for (i, _, _), c in zip(pairs, brute(pairs)):
        where[c].append(i)
    want = sorted((sorted(map(str, ids)), len(ids)) for ids in where.values())
    have = defaultdict(list)
    for r in got:
        have[r.class_id, r.class_size].append(r.doc_id)
    by_id = Counter()
    for (c, n), ids in have.items():
        by_id[tuple(sorted(map(str, ids)))] += 1
    flat = sorted((list(k), len(k)) for k, n in by_id.items() for _ in range(n))
    if None not in [i for i, *_ in pairs]:
        assert flat == want
    assert sum(r.kept for r in got) == len(where)


def test_fixture_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pairs = [(r.doc_id, r.text, "") for r in df.collect()]
    check(nd.near_dedup(df).collect(), pairs)


def test_edges(docs, edges):
    got = nd.near_dedup(docs(edges)).collect()
    assert len(got) == len(edges)
    check(got, edges)
    assert nd.near_dedup(docs([])).collect() == []
    assert {r.class_id for r in nd.near_dedup(docs([(1, None, "a"), (2, "", "a")])).collect()} == {1}


def test_hot_group_of_near_copies(docs):
    """Copies with changes of their own, half alike among themselves only through the base."""
    draw = random.Random(4)
    base = [f"b{draw.randrange(10**6)}" for _ in range(300)]
    common = [f"c{i}" for i in range(120)]
    pairs = [(0, " ".join(base), "a")]
    for i in range(1, 120):
        w = list(base)
        for _ in range(draw.randrange(1, 6)):
            w[draw.randrange(300)] = f"x{draw.randrange(10**6)}"
        pairs.append((i, " ".join(w), "a"))
    pairs += [(1000 + i, " ".join(common + [f"u{i}w{j}" for j in range(100)]), "a") for i in range(120)]  # one passage, 0.37 alike
    check(nd.near_dedup(docs(pairs)).collect(), pairs)


def test_no_column_depends_on_the_pairs_tested(docs):
    assert nd.near_dedup(docs([(1, "a b", "a")])).columns == ["doc_id", "class_id", "class_size", "kept"]


def star(n, draw, edits=5, size=300):
    """n copies of a text with `edits` words replaced, and the text itself as the last row."""
    base = [f"b{draw.randrange(10**6)}" for _ in range(size)]
    out = []
    for i in range(n):
        w = list(base)
        for at in draw.sample(range(size), edits):
            w[at] = f"x{draw.randrange(10**6)}"
        out.append((i, " ".join(w), "a"))
    return out + [(n, " ".join(base), "a")]


@pytest.mark.parametrize("many", [nd.MANY_PAIRS, 10**12, 0])
def test_star_of_copies_alike_through_the_base_only(docs, monkeypatch, many):
    """Uniform edits: each copy is 0.84 like the base, and less than 0.8 like the others."""
    monkeypatch.setattr(nd, "MANY_PAIRS", many)
    pairs = star(1000, random.Random(9))
    assert len(set(brute(pairs))) == 1
    check(nd.near_dedup(docs(pairs)).collect(), pairs)


def test_buckets_cut_by_parts(docs, monkeypatch):
    """One bucket, up to a row a part: two copies that only the last row, their base, joins."""
    pairs = star(2, random.Random(0), edits=6)
    assert len(set(brute(pairs))) == 1 and len(set(brute(pairs[:2]))) == 2
    for parts in (1, 3):
        monkeypatch.setattr(nd, "partitions", lambda spark: parts)
        check(nd.near_dedup(docs(pairs).coalesce(1).sortWithinPartitions("doc_id"), bands=1, rows=1).collect(), pairs)


@pytest.mark.parametrize("scale", [1.0, 2.5, 0.3])
def test_signatures_estimate_weighted_similarity(scale):
    draw = np.random.default_rng(1)
    e = nd.mix(np.arange(400, dtype=np.uint64))
    wa, wb = draw.random(400) * scale + 0.01, draw.random(400) * scale + 0.01
    s = nd.signatures(np.repeat([0, 1], 400), np.concatenate([e, e]), np.concatenate([wa, wb]), 2, 1500)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((s[0] == s[1]).mean() - want) < 0.05 and (s != 0).all()


def test_jaccard():
    b = lambda *x: np.array(x, "<u4").tobytes()
    assert nd.jaccard(b(1, 2, 3), b(2, 3, 9)) == 0.5 and nd.jaccard(b(), b()) == 1 and nd.jaccard(b(), b(1)) == 0
    assert nd.jaccard(b(1, 2), b(2, 7), b(1, 3), b(2, 1)) == pytest.approx(2 / 5)


def test_weighted_by_counts(docs):
    t = " ".join(f"w{i}" for i in range(60))
    pairs = [(1, t, "a"), (2, " ".join([t] * 3), "a"), (3, t + " end", "a")]
    ids = {w: {r.doc_id: r.class_id for r in nd.near_dedup(docs(pairs), weigh=w).collect()} for w in ("set", "count")}
    assert ids["set"] == {1: 1, 2: 1, 3: 1} and ids["count"] == {1: 1, 2: 2, 3: 1}


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(6000, 6300)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("many", [0, 1, 40, 400])
def test_merged_roots_are_those_of_all_edges(spark, many):
    draw = random.Random(many)
    old = [(draw.randrange(500), draw.randrange(500)) for _ in range(200)]
    new = [(draw.randrange(600), draw.randrange(600)) for _ in range(many)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    of = lambda df: sorted(tuple(r) for r in df.collect())
    assert of(merged(components(frame(old)), frame(new))) == of(components(frame(old + new)))
    assert of(merged(components(frame([])), frame(new))) == of(components(frame(new)))


def test_small_tables_take_few_tasks(spark):
    """Nothing but partitions for far larger tables: a stage of few rows is not cut in 211."""
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    edges = spark.createDataFrame([(i, i // 3) for i in range(1, 300)], "a long, b long")
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("few-tasks", "components")
        assert {r.root for r in components(edges).collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
    assert stages and sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i) < 1500
