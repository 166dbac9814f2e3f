import math
import re

import pytest

from quern.llm.mixing import mix, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Share out by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > most * sizes[s] + 1e-9]
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 100, "b": 3, None: 50}, {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}, {"a": 0, "b": 5}])
def test_targets(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = water(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want


def test_taken_meets_targets_and_reruns_agree(docs):
    pairs = [(i, "w " * (i * 7919 % 97 + 1), "big" if i % 3 else f"s{i % 11}") for i in range(3000)] + [(None, "q r s", None)]
    a, b = ({(r.doc_id, r.size, r.taken, r.target) for r in mix(docs(p)).collect()} for p in (pairs, pairs[::-1]))
    assert a == b
    sums, targets, sizes = {}, {}, {}
    for i, t, s in pairs:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    source = {(i, len(WORDS.findall(t))): s for i, t, s in pairs}
    for i, size, taken, target in a:
        s = source[i, size]
        sums[s], targets[s] = sums.get(s, 0) + taken, target
        assert 0 <= taken <= 2 * size
    assert targets == pytest.approx(water(sizes))
    for s in sums:
        assert abs(sums[s] - targets[s]) <= 1


def test_edges(docs, edges):
    got = mix(docs(edges)).collect()
    assert len(got) == len(edges)
    assert sorted(r.size for r in got) == sorted(len(WORDS.findall(t or "")) for _, t, _ in edges)
    assert all(0 <= r.taken <= 2 * r.size and not math.isnan(r.target) for r in got)
    assert mix(docs([])).collect() == []


def test_selection_follows_keys(docs):
    """Against the method in plain Python."""
    import hashlib

    pairs = [(i, ("abcdef ", "a1b2-- ", "//12 ")[i % 3] * (i % 13 + 1), "ab"[i % 2]) for i in range(400)]
    want = {}
    sizes = {s: sum(i % 13 + 1 for i, _, x in pairs if x == s) for s in "ab"}
    for s, target in water(sizes).items():
        keyed = []
        for i, t, x in pairs:
            if x == s:
                n = i % 13 + 1
                u = (int(hashlib.md5(f"7:{i}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                seen = re.sub(r"\s+", "", t)
                share = len(re.sub(r"[^a-z]", "", t)) / len(seen)
                keyed.append((-math.log(u) / max(0.01, share * share), i, n))
        epochs, ahead = int(target // sizes[s]), 0
        for _, i, n in sorted(keyed):
            want[i] = epochs * n + max(0, min(n, round(target) - epochs * sizes[s] - ahead))
            ahead += n
    assert {r.doc_id: r.taken for r in mix(docs(pairs)).collect()} == want


def test_slices_of_a_source_without_spaces_are_even(spark):
    """The place of a row in the mix is found among few others, whatever the script."""
    from pyspark.sql import functions as F

    from quern.llm import mixing

    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("\u6f22\u5b57"), 200).alias("text"), F.lit("s").alias("source"))
    keys = df.select((-F.log(mixing.uniform(F.col("doc_id"), 7)) / mixing.quality_weight(F.col("text"))).alias("key"))
    cells = 20_000 // mixing.ROWS_A_CELL
    assert keys.groupBy(F.floor(F.log("key") * cells)).count().agg(F.max("count")).first()[0] < 0.02 * 20_000
    got = mix(df).agg(F.sum("taken"), F.max("target")).first()
    assert abs(got[0] - got[1]) <= 1


def test_rows_that_repeat_do_not_depend_on_the_split(docs):
    pairs = [(i % 5, "w " * (1 + i % 7), "a") for i in range(60)]
    a, b = (sorted((r.doc_id, r.size, r.taken) for r in mix(docs(p).repartition(n)).collect()) for p, n in ((pairs, 1), (pairs[::-1], 9)))
    assert a == b
