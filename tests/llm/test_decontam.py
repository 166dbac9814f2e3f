import hashlib
import random
import re
from collections import Counter

from quern.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(pairs, items, n=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t, _ in pairs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                who = windows.get(tuple(w[s : s + size]))
                if who:
                    hit |= set(range(s, s + size))
                    found |= who
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def run(spark, docs, pairs, items):
    return Counter(tuple(r) for r in decontam.decontaminate(docs(pairs), spark.createDataFrame(items, "item_id long, text string")).collect())


def test_random_texts_of_few_words(spark, docs):
    draw = random.Random(3)
    text = lambda n, k: " ".join(draw.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, text(draw.randrange(0, 25), 8 if i % 2 else 2)) for i in range(30)] + [(7, text(12, 1)), (None, "a b"), (50, None), (51, "zz never"), (52, "h")]
    pairs = [(i, text(draw.randrange(0, 60), 2 + i % 6), "a") for i in range(80)]
    pairs += [(100 + k, f"X {t.upper()}; y", "a") for k, (_, t) in enumerate(items) if t]
    assert run(spark, docs, pairs, items) == brute(pairs, items)


def test_edges(spark, docs, edges):
    items = [(1, "one two three"), (2, " ".join(f"word{i % 9173}x{i % 31}" for i in range(500, 540))), (3, "Ü K")]
    assert run(spark, docs, edges, items) == brute(edges, items)
    assert run(spark, docs, edges, []) == brute(edges, [])
    assert run(spark, docs, [], items) == Counter()


def test_fixture_documents(spark):
    d = "/root/testdata/sf0.001"
    df, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    got = Counter(tuple(r) for r in decontam.decontaminate(df, items).collect())
    assert got == brute([(r.doc_id, r.text, "") for r in df.collect()], [tuple(r) for r in items.collect()])


def test_without_broadcasts(spark, docs, monkeypatch):
    monkeypatch.setattr(decontam, "SMALL", -1)
    items, pairs = [(1, "a b c d e f g h i j k l"), (2, "c d")], [(1, "x a b c d e f g h i j k l", "a"), (2, "c d", "a"), (3, "d c", "a")]
    assert run(spark, docs, pairs, items) == brute(pairs, items)


def test_proximity(spark, docs):
    draw = random.Random(5)
    pairs = [(i, " ".join(draw.choice("pqrst") for _ in range(40)), "a") for i in range(20)]
    terms = decontam.vocabulary(spark.createDataFrame([("p q r",)], "text string"))
    index = decontam.build_index(docs(pairs), terms)
    ask = spark.createDataFrame([(1, "p", "q"), (2, "r", "p"), (3, "p", "none")], "query int, a string, b string")
    got = decontam.proximity_matches(index, ask, 3).join(index.docs, "row").collect()
    want = set()
    for i, t, _ in pairs:
        w = t.split()
        for q, a, b in ((1, "p", "q"), (2, "r", "p")):
            for p, x in enumerate(w):
                near = [k for k in range(max(0, p - 3), p) if w[k] == b]
                if x == a and near:
                    want.add((i, q, p, near[-1]))
    assert {(r.doc_id, r.query, r.pos, r.other) for r in got} == want


def test_proximity_on_both_sides(spark, docs):
    draw = random.Random(6)
    pairs = [(i, " ".join(draw.choice("pqrstuv") for _ in range(40)), "a") for i in range(20)] + [(20, "p q", "a"), (21, "q p", "a")]
    index = decontam.build_index(docs(pairs), decontam.vocabulary(spark.createDataFrame([("p q r",)], "text string")))
    queries = [(1, "p", "q"), (2, "r", "p"), (3, "q", "q")]
    ask = spark.createDataFrame(queries, "query int, a string, b string")
    got = decontam.proximity_matches(index, ask, 3, both=True).join(index.docs, "row").collect()
    want = []
    for i, t, _ in pairs:
        w = t.split()
        for q, a, b in queries:
            for p in (p for p, x in enumerate(w) if x == a):
                want += [(i, q, p, k) for k in [k for k in range(max(0, p - 3), p + 1) if w[k] == b][-1:]]
                want += [(i, q, p, k) for k in [k for k in range(p + 1, min(len(w), p + 4)) if w[k] == b][:1]]
    assert sorted((r.doc_id, r.query, r.pos, r.other) for r in got) == sorted(want)
