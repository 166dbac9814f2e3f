import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quern.llm import merkle

SCHEMA = "doc_id long, source string, claim string, text string, tree int, at int, path string, block int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(items):
    """The root of (node, members) in order, and each member's siblings level by level."""
    level, paths = [(n, [m]) for n, m in items], defaultdict(list)
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 16):
            run = level[k : k + 16]
            for j, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(n for n, _ in run[:j]), "".join(n for n, _ in run[j + 1 :])))
            above.append((h(*[n for n, _ in run]), [m for _, ms in run for m in ms]))
        level = above
    return level[0][0], paths


def brute(rows):
    by = defaultdict(list)
    for i, (doc, source, _) in enumerate(rows):
        by[source].append((doc is not None, doc or 0, h(str(doc)), i))
    subs, below = [], {}
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        root, paths = tree([(x[2], x[3]) for x in sorted(by[s])])
        subs.append((root, s))
        below |= {x[3]: paths[x[3]] for x in by[s]}
    top, upper = tree(subs)
    out = []
    for i, (doc, source, claim) in enumerate(rows):
        path, folded = below[i] + upper[source], claim or h(str(doc))
        for before, after in path:
            folded = h(before, folded, after)
        out.append((doc, h(str(doc)), dict((s, r) for r, s in subs)[source], top, h(*[x for p in path for x in p]), folded, folded == top))
    return sorted(out, key=str)


def run(spark, rows, levels):
    df = spark.createDataFrame([(*r, "x", 1, 1, "x", 1) for r in rows], SCHEMA).repartition(3)
    leaf = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), 256)
    got = merkle.manifest(df, leaf, claimed=F.col("claim"), block_levels=levels)
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("levels", [1, 3])
def test_trees_of_all_sizes(spark, levels):
    sizes = {"a": 1, "b": 2, None: 16, "é": 17, "": 33, "big": 700, **{f"s{k:02}": 1 + k for k in range(20)}}
    ids = iter(range(10_000))
    rows = [(next(ids) * 7 % 10_007, s, "wrong" if k % 5 == 0 else None) for s, n in sizes.items() for k in range(n)]
    assert run(spark, rows, levels) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a", None), (1, "a", None), (None, "a", None), (2, None, "x"), (None, None, None)]
    assert run(spark, rows, 2) == brute(rows)


def test_one_row_and_none(spark):
    assert run(spark, [(5, "a", None)], 3) == [(5, h("5"), h("5"), h("5"), h(), h("5"), True)]
    assert run(spark, [], 3) == []


def test_row_digest(spark, docs, edges):
    want = []
    for i, t, s in edges:
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, None, t)]
        want.append(h(*parts))
    got = docs(edges).select(merkle.row_digest([F.col(c) for c in ("doc_id", "source", "lang", "text")]).alias("d")).collect()
    assert sorted(r.d for r in got) == sorted(want)


@pytest.mark.parametrize("count", [1, 2, 15, 16, 17, 255, 256, 257, 600])
def test_traversal_folds_to_the_root(count):
    leaves = [h(str(i)) for i in range(count)]
    levels = merkle._levels(count, 3)
    top = merkle.root(leaves, levels)
    assert top == tree([(n, i) for i, n in enumerate(leaves)])[0]
    assert all(merkle.fold(n, p) == top for n, p in zip(leaves, merkle.traverse(leaves, levels)))


def test_stacks_stay_small():
    tree_hash = merkle.TreeHash(4)
    for i in range(50_000):
        tree_hash.push(h(str(i)))
        assert all(len(run) < merkle.ARITY for run in tree_hash.runs)
