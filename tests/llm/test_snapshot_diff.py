import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import snapshot_diff as sd
from quern.llm.queries import later_snapshot

SCHEMA = "doc_id long, text string, lang string, source string, k long, part long, sign long, n long, rank long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], SCHEMA).repartition(3)


def diff(spark, a, b):
    got = sd.snapshot_diff(table(spark, a), table(spark, b), keep=F.concat_ws("|", "text", "source"))
    return Counter(tuple(r) for r in got.select("key", "old_key", "op", "changed", "kept").collect())


def brute(a, b):
    """For keys that don't repeat, but for rows that are equal."""
    kept = lambda r: "|".join(x for x in (r[1], r[3]) if x is not None)
    changed = lambda x, y: ",".join(c for c, p, q in zip(("text", "lang", "source"), x[1:], y[1:]) if p != q)
    out, olds, news = [], defaultdict(list), defaultdict(list)
    for r in a:
        olds[r[0]].append(r)
    for r in b:
        news[r[0]].append(r)
    left, right = [], []
    for key in {*olds, *news}:
        x, y = Counter(olds[key]), Counter(news[key])
        out += [(key, key, "same", "", kept(r)) for r in (x & y).elements()]
        x, y = list((x - y).elements()), list((y - x).elements())
        assert min(len(x), len(y)) <= 1 and (not (x and y) or max(len(x), len(y)) == 1)
        if x and y:
            out.append((key, key, "update", changed(x[0], y[0]), kept(y[0])))
        else:
            left, right = left + x, right + y
    order = lambda r: (r[0] is not None, r[0] or 0)
    by = defaultdict(lambda: ([], []))
    for r in sorted(left, key=order):
        by[r[1:3]][0].append(r)
    for r in sorted(right, key=order, reverse=True):
        by[r[1:3]][1].append(r)
    for x, y in by.values():
        n = min(len(x), len(y))
        out += [(q[0], p[0], "rekey", changed(p, q), kept(q)) for p, q in zip(x, y)]
        out += [(p[0], p[0], "delete", "", None) for p in x[n:]] + [(q[0], None, "insert", "", kept(q)) for q in y[n:]]
    return Counter(out)


EARLIER = [(1, "a", "en", "s"), (2, None, "en", None), (3, "", None, "s"), (None, "no key", "en", "s"), (4, "hot", "en", "s"), (5, "hot", "en", "t"), (6, "hot", "en", None), (7, "~", None, None), (8, "x", "en", "s"), (-9, "neg", "de", "s"), (0, "zero", "en", "s"), (10, "a,b", "c", "d"), (11, "long " * 30_000, "en", "s")]
LATER = [(1, "a", "en", "s"), (2, None, "en", "s"), (3, None, None, "s"), (None, "no key", "en", "t"), (-4, "hot", "en", "s"), (-5, "hot", "en", "s"), (20, "hot", "en", None), (21, "hot", "en", None), (7, None, None, None), (9, "neg", "de", "s"), (0, "zero", "en", "s"), (10, "a", "b,c", "d"), (11, "long " * 30_000, "en", "s"), (22, "long " * 30_000, "en", "s")]


def test_edges(spark):
    got = diff(spark, EARLIER, LATER)
    assert got == brute(EARLIER, LATER)
    assert {k[2] for k in got} == {"same", "update", "rekey", "insert", "delete"}


def test_null_key_is_not_zero(spark):
    assert diff(spark, [(None, "a", None, None)], [(0, "a", None, None)]) == Counter({(0, None, "rekey", "", "a"): 1})


def test_rows_that_repeat(spark):
    a = [(1, "a", "en", "s")] * 3 + [(2, "b", "en", "s")] * 2 + [(3, "c", "en", "s")] * 2 + [(4, "d", "en", "s")] * 2
    b = [(1, "a", "en", "s")] * 2 + [(2, "b", "en", "s")] * 4 + [(30, "c", "en", "s")] * 3 + [(4, "d", "en", "s")] * 2
    assert diff(spark, a, b) == brute(a, b)


def test_a_key_that_repeats_with_other_rows(spark):
    a = [(1, f"old {i}", "en", "s") for i in range(300)] + [(1, "both", "en", "s")]
    b = [(1, f"new {i}", "en", "s") for i in range(200)] + [(1, "both", "en", "s")]
    got = diff(spark, a, b)
    assert Counter(k[2] for k, n in got.items() for _ in range(n)) == {"same": 1, "update": 200, "delete": 100}


def test_empty_tables(spark):
    assert diff(spark, [], []) == Counter()
    assert diff(spark, EARLIER, []) == brute(EARLIER, [])
    assert diff(spark, [], LATER) == brute([], LATER)


def test_a_content_that_many_rows_share(spark):
    a = [(i, "same" if i % 3 else f"t{i % 40}", "en", f"s{i % 7}") for i in range(3000)]
    b = [((-1 - i) if i % 2 else i, t, lang, None if i % 5 == 0 else s) for i, t, lang, s in a if i % 11]
    assert diff(spark, a, b) == brute(a, b)


@pytest.mark.parametrize("what", ["cells", "peel", "verify"])
def test_small_tables_are_enlarged_and_wrong_ones_counted(spark, monkeypatch, what):
    r = random.Random(1)
    a = [(i, f"text {i}", "en", "s") for i in range(2500)]
    b = [(i, t + "+" * (r.random() < 0.5), lang, s) for i, t, lang, s in a if r.random() < 0.9]
    if what == "cells":
        monkeypatch.setattr(sd, "SAMPLED", 10**9)  # nothing is known of the size
    elif what == "peel":
        monkeypatch.setattr(sd, "SAMPLED", 10**9)
        monkeypatch.setattr(sd, "ROUNDS", 1)
    else:
        whole = sd.difference
        monkeypatch.setattr(sd, "difference", lambda *x: whole(*x).where("k % 50 <> 3"))  # entries are lost
    assert diff(spark, a, b) == brute(a, b)


def test_hash_is_sparks(spark):
    rows = spark.range(50).selectExpr("(id - 25) * 92233720368547758 AS k", "id AS d0", "-id * id AS d1")
    got = rows.select("k", "d0", "d1", sd._hashed(-2).alias("h")).collect()
    columns = [np.array([getattr(x, c) for x in got], np.int64) for c in ("k", "d0", "d1")]
    assert sd._xxhash64(-2, *columns).tolist() == [x.h for x in got]


def test_peeling():
    r = np.random.default_rng(4)
    entries = r.integers(-(2**62), 2**62, (3, 500))
    signs = r.choice([-1, 1], 500)
    check = sd._xxhash64(-1, *entries)

    def cells(size):
        n, sums = np.zeros(size, np.int64), np.zeros((4, size), np.int64)
        for j in range(sd.HASHES):
            at = sd._xxhash64(8 + j, *entries) % (size // 3) + j * (size // 3)
            np.add.at(n, at, signs)
            for s, v in zip(sums, [*entries, check]):
                np.bitwise_xor.at(s, at, v)
        at = np.flatnonzero(n | sums.any(axis=0))
        return sd.peeled(size, 1, at, n[at], sums[:, at])

    found, got, whole = cells(900)
    assert whole and sorted(zip(*found.tolist(), got.tolist())) == sorted(zip(*entries.tolist(), signs.tolist()))
    assert not cells(300)[2]


def test_later_snapshot_of_the_query(spark):
    from zlib import crc32

    rows = [(i, "t" if i % 2 else None, "en", "s") for i in range(200)]
    got = Counter(tuple(r) for r in later_snapshot(table(spark, rows)).collect())
    want = []
    for i, t, lang, s in rows:
        k = crc32(str(i).encode()) % 25
        own = {0: [], 1: [(i, (t or "") + "+", lang, s)], 2: [(i, t, s, lang)], 3: [(-1 - i, t, lang, s)], 4: [(-1 - i, t, lang, None)], 5: [(i, t, lang, s), (-1 - i, t, lang, s)]}
        want += own.get(k, [(i, t, lang, s)])
    assert got == Counter(want)
