import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import suffix_dedup as sd
from quern.llm._words import chunks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(pairs, least):
    """Words of each text covered by windows of `least` words that another row has, as merged spans."""
    texts = [WORD.findall((t or "").translate(LOWER)) for _, t, _ in pairs]
    where = {}
    for d, w in enumerate(texts):
        for s in range(len(w) - least + 1):
            where.setdefault(tuple(w[s : s + least]), set()).add(d)
    out = []
    for d, w in enumerate(texts):
        spans = []
        for s in range(len(w) - least + 1):
            if where[tuple(w[s : s + least])] - {d}:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + least
                else:
                    spans.append([s, s + least])
        out += [(str(pairs[d][0]), a, b) for a, b in spans]
    return sorted(out)


def run(docs, pairs, **how):
    got = sd.repeated_passages(docs(pairs), **how).collect()
    texts = {}
    for i, t, _ in pairs:
        texts.setdefault(i, []).append(WORD.findall((t or "").translate(LOWER)))
    for r in got:
        assert r.n_words == r.end - r.start
        w = texts[r.other_id]
        own = [x[r.start : r.end] for x in texts[r.doc_id]]
        least = how.get("min_words", 50)
        assert any(tuple(x[r.other_start : r.other_start + least]) in {tuple(o[s : s + least]) for o in own for s in range(len(o) - least + 1)} for x in w)
    return sorted((str(r.doc_id), r.start, r.end) for r in got)


@pytest.mark.parametrize("least,k,letters", [(50, 10, 10**6), (12, 4, 40), (20, 5, 200)])
def test_random_texts(docs, least, k, letters):
    draw = random.Random(least)
    word = lambda: f"w{draw.randrange(letters)}"
    passages = [[word() for _ in range(n)] for n in (least - 1, least, least + 1, least * 2, least * 5)]
    pairs = []
    for i in range(60):
        w = []
        for _ in range(draw.randrange(0, 4)):
            w += [word() for _ in range(draw.randrange(0, 80))] + draw.choice(passages)
        pairs.append((i, " ".join(w), "a"))
    assert run(docs, pairs, min_words=least, k=k) == brute(pairs, least)


def test_texts_of_few_words(docs, monkeypatch):
    """Low entropy: every key is in many texts, and pieces are cut inside keys."""
    draw = random.Random(4)
    pairs = [(i, " ".join(f"w{draw.randrange(3)}" for _ in range(draw.randrange(0, 60))), "a") for i in range(150)]
    want = brute(pairs, 10)
    assert len(want) > 50
    for piece in (sd.PIECE, 64, 1):
        monkeypatch.setattr(sd, "PIECE", piece)
        assert run(docs, pairs, min_words=10, k=3) == want


def test_places_of_one_text_in_another_piece(docs, monkeypatch):
    """A has a window five times, B once, in pieces of one suffix."""
    p = " ".join(f"p{i}" for i in range(12))
    pairs = [(1, f"{p} a {p} b {p} c {p} d {p}", "a"), (2, f"q {p} r", "a")]
    for piece in (1, 2, 7):
        monkeypatch.setattr(sd, "PIECE", piece)
        assert run(docs, pairs, min_words=10, k=3) == brute(pairs, 10)


def test_two_texts_with_others_between(docs):
    """A and C share 50 words; 12 texts share those from the 27th on and go on with A a little."""
    passage, more = [f"p{i}" for i in range(50)], [f"m{i}" for i in range(30)]
    texts = [["a"] * 3 + passage + more, ["c"] * 3 + passage + ["d"] * 30]
    texts += [[f"l{i}"] * 5 + passage[26:] + more[: 5 + i * 19 // 11] + [f"e{i}"] * 9 for i in range(12)]
    pairs = [(i, " ".join(w), "a") for i, w in enumerate(texts)]
    got = run(docs, pairs)
    assert got == brute(pairs, 50) and {x[0] for x in got} >= {"0", "1"}


def test_one_passage_in_all_texts(docs):
    passage = " ".join(f"p{i}" for i in range(55))
    pairs = [(i, f"u{i} v{i} {passage} x{i}", "a") for i in range(200)]
    assert run(docs, pairs) == sorted((str(i), 2, 57) for i in range(200))


@pytest.mark.parametrize("parts,piece", [(1, 50_000), (40, 50_000), (3, 20)])
def test_shared_part_after_other_leads(docs, monkeypatch, parts, piece):
    """lead + M in two texts, M in 100 others that go on differently, so that they sort between."""
    monkeypatch.setattr(sd, "partitions", lambda spark: parts)
    monkeypatch.setattr(sd, "PIECE", piece)
    draw = random.Random(8)
    word = lambda: f"w{draw.randrange(10**6)}"
    texts = []
    for n in range(30, 38):
        m, lead = [word() for _ in range(n)], [word() for _ in range(52 - n)]
        texts += [[word() for _ in range(30)] + lead + m + [word() for _ in range(60)] for _ in range(2)]
        texts += [[word() for _ in range(30)] + m + [word() for _ in range(60)] for _ in range(100)]
    pairs = [(i, " ".join(w), "a") for i, w in enumerate(texts)]
    want = brute(pairs, 50)
    assert len(want) == 16 and run(docs, pairs) == want


def test_edges(docs, edges):
    assert run(docs, edges) == brute(edges, 50)
    assert sd.repeated_passages(docs([])).collect() == []


def test_within_a_text(docs):
    p = " ".join(f"p{i}" for i in range(60))
    pairs = [(1, f"{p} a b c {p}", "a"), (2, "q", "a")]
    assert run(docs, pairs) == [] and run(docs, pairs, across=False) == [("1", 0, 60), ("1", 63, 123)]


def test_fixture_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted((str(r.doc_id), r.start, r.end) for r in sd.repeated_passages(df).collect())
    want = brute([(r.doc_id, r.text, "") for r in df.collect()], 50)
    assert len(got) == len(want)
    assert sum(x != y for x, y in zip(got, want)) <= 1  # 16 bits a word


def test_minimisers_are_those_of_the_windows():
    draw = random.Random(1)
    texts = [" ".join(f"w{draw.randrange(5)}" for _ in range(n)) for n in (0, 3, 9, 10, 11, 40, 200)]
    for _, w in chunks(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])):
        g = sd.run_hashes(w, 4)
        want = set()
        for a, b in zip(w.ptr, w.ptr[1:]):
            for s in range(a, b - 4 - 7 + 2):
                want.add(s + int(np.argmin(g[s : s + 7])))
        at, h = sd.minimisers(w, 4, 7)
        assert at.tolist() == sorted(want) and (h == g[at]).all()
