import hashlib
from collections import defaultdict

from quern.llm.exact_dedup import MAX_BITS, exact_dedup, filter_bits, possibly_repeated, repeated_slots


def brute(pairs):
    by = defaultdict(list)
    for i, t, _ in pairs:
        by[t or ""].append(i)
    return by


def test_edges(docs, edges):
    got = exact_dedup(docs(edges)).collect()
    by = brute(edges)
    assert len(got) == len(edges)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in by.items()}
    for r in got:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(by)  # of rows that repeat, ids included, one stays


def test_empty_table(docs):
    assert exact_dedup(docs([])).collect() == []


def test_all_rows_alike(docs):
    got = exact_dedup(docs([(i, "same", "a") for i in range(500)])).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(499, 500)} and sum(r.kept for r in got) == 1


def test_saturated_filter_gives_the_same(docs, monkeypatch):
    pairs = [(i, f"text {i % 700}", "a") for i in range(1000)]
    want = {tuple(r) for r in exact_dedup(docs(pairs)).collect()}
    monkeypatch.setattr("quern.llm.exact_dedup.filter_bits", lambda n: 1 << 7)
    assert {tuple(r) for r in exact_dedup(docs(pairs)).collect()} == want


def test_filter_bits_are_bounded():
    assert filter_bits(0) == 1 << 17 and filter_bits(10**12) == MAX_BITS == 1 << 30


def test_largest_filter_tells_repeated_rows(spark):
    digests = spark.range(3000).selectExpr("id", "unhex(sha2(cast(id % 2900 as string), 256)) AS digest")
    got = possibly_repeated(digests, repeated_slots(digests, MAX_BITS), MAX_BITS).where("__maybe").collect()
    assert sorted(r.id for r in got) == [*range(100), *range(2900, 3000)]
