import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quern.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(pairs, tau):
    """(id, line_no) -> copies, links, class (as a set of lines)."""
    lines = [(i, k, x) for i, t, _ in pairs if t is not None for k, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]
    count = Counter(x for _, _, x in lines)
    distinct = sorted(count)
    root, links = {x: x for x in distinct}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            if abs(len(a) - len(b)) <= tau and distance(a, b) <= tau:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    return lines, count, links, find


def check(got, pairs, tau=ld.TAU):
    lines, count, links, find = brute(pairs, tau)
    want = Counter((i, k, count[x], links[x]) for i, k, x in lines)
    assert Counter((r.doc_id, r.line_no, r.copies, r.n_links) for r in got) == want
    text = defaultdict(list)
    for i, k, x in lines:
        text[i, k].append(x)
    classes = defaultdict(set)
    for r in got:
        classes[r.class_id].add((r.doc_id, r.line_no))
    assert len(classes) == len({find(x) for x in count}) == sum(r.kept for r in got)
    for members in classes.values():
        assert any(len({find(x) for x in pick}) == 1 for pick in [[x for m in members for x in text[m]]]) or any(len(text[m]) > 1 for m in members)


def mutated(draw, line, edits, letters):
    w = list(line)
    for _ in range(edits):
        i = draw.randrange(len(w) + 1)
        w[i : i + draw.randrange(2)] = draw.choice(letters) * draw.randrange(2)
    return "".join(w)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_random_lines(docs, tau):
    draw = random.Random(tau)
    pairs = []
    for i in range(40):
        lines = []
        for _ in range(6):
            base = "".join(draw.choice("ab é") for _ in range(draw.choice([0, 1, 2, 4, 7, 12, 30])))
            lines += [mutated(draw, base, draw.randrange(0, tau + 3), "abé\U0001f600") for _ in range(3)]
        pairs.append((i, "\n".join(lines), "a"))
    check(ld.line_dedup(docs(pairs), tau=tau).collect(), pairs, tau)


def test_edges(docs, edges):
    few = [(i, t if t is None or len(t) < 1000 else t[:3000], s) for i, t, s in edges]
    check(ld.line_dedup(docs(few)).collect(), few)
    assert ld.line_dedup(docs([])).collect() == []


def test_very_long_lines(docs, edges):
    got = ld.line_dedup(docs([e for e in edges if e[0] in (6, 7)] + [(10, edges[6][1] + "!", "a")])).collect()
    assert {(r.doc_id, r.copies, r.n_links) for r in got} == {(6, 2, 1), (7, 2, 1), (10, 1, 1)} and len({r.class_id for r in got}) == 1


def test_distance(spark):
    draw = random.Random(9)
    pairs = []
    while len(pairs) < 1500:
        a = "".join(draw.choice("ab") for _ in range(draw.randrange(0, 12)))
        b = mutated(draw, a, draw.randrange(0, 5), "abc")
        if abs(len(a) - len(b)) <= 2:
            pairs.append((a, b))
    for r in spark.createDataFrame(pairs, "x string, y string").select("x", "y", ld.within("x", "y", 2).alias("d")).collect():
        assert min(r.d, 3) == min(distance(r.x, r.y), 3)


def test_segments_partition(spark):
    for n in range(4, 30):
        cells = [ld.segment(str(n), str(k), 3) for k in range(3)]
        got = spark.range(1).select(*[F.expr(x).alias(f"c{i}{j}") for i, c in enumerate(cells) for j, x in enumerate(c)]).first()
        at = 0
        for i in range(3):
            assert got[2 * i] == at and n // 3 <= got[2 * i + 1] <= n // 3 + 1
            at += got[2 * i + 1]
        assert at == n


def test_short_lines(docs, monkeypatch):
    """Against brute force, and without a pair for each two of them."""
    draw = random.Random(3)
    pairs = [(i, "\n".join("".join(draw.choice("abcé\U0001f600") for _ in range(draw.randrange(1, 6))) for _ in range(5)), "a") for i in range(25)]
    check(ld.line_dedup(docs(pairs)).collect(), pairs)

    made, edit_links = [], ld.edit_links
    monkeypatch.setattr(ld, "edit_links", lambda *a: made.append(edit_links(*a)) or made[-1])
    many = [(i, "\n".join(chr(0x4E00 + 100 * i + k) for k in range(100)) + "\nabc", "a") for i in range(30)]
    got = ld.line_dedup(docs(many)).where("n_links > 0").collect()
    assert len(got) == 3000 and {r.n_links for r in got} == {2999} and len({r.class_id for r in got}) == 1 and sum(r.kept for r in got) == 1
    assert made[0].count() == 0
