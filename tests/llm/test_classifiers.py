import zlib

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import quality, toxicity
from quern.llm._words import chunks


def pieces(texts):
    return [w for _, w in chunks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]))]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def auc(scores, marks):
    rank = np.argsort(np.argsort(scores))
    p = marks.sum()
    return (rank[marks == 1].sum() - p * (p - 1) / 2) / (p * (len(marks) - p))


def test_toxic_features_by_hand():
    (w,) = pieces(["a b c", None, "A  b"])
    index, owner = toxicity.features(w)
    h = {}
    for i, o in zip(index, owner):
        h.setdefault(int(o), []).append(int(i))
    assert len(h[0]) == 3 + 2 + 1 and len(h[2]) == 2 + 1 and 1 not in h
    assert set(h[2]) < set(h[0])


def test_ftrl_is_sparse_and_learns():
    m = toxicity.Ftrl(8.0)
    draw = np.random.default_rng(0)
    for _ in range(600):
        bad = int(draw.random() < 0.3)
        i = np.unique(np.concatenate([draw.integers(100, 5000, 20), [7] if bad else []]).astype(int))
        m.learn(i, bad)
    at, w, bias = m.model()
    assert at[np.argmax(w)] == 7 and len(at) < 50 and bias < 0


@pytest.mark.parametrize("module,folds,out,at", [(toxicity, 5, 0, 0.5), (quality, 4, 2, 0.7)])
def test_edges(spark, docs, edges, module, folds, out, at):
    run = module.toxicity if module is toxicity else module.quality
    for lab in ([], [(4, 1, 0), (6, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 1), (4, 1, 0)]):
        got = run(docs(edges), labels(spark, lab)).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in edges)
        for r in got:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= at)
            assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % folds == out)
    assert run(docs([]), labels(spark, [])).collect() == []


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for run, mark in ((toxicity.toxicity, "toxic"), (quality.quality, "quality")):
        got = run(docs, lab).join(lab, "doc_id").where("held_out").toPandas()
        assert auc(got.score.to_numpy(), got[mark].to_numpy()) > 0.97
        assert (got.predicted == got[mark]).mean() > 0.95


def test_machine_equals_the_sum_over_pairs():
    draw = np.random.default_rng(3)
    m = quality.Machine(0.3)
    m.w[:], m.v[:] = draw.normal(size=m.w.shape), draw.normal(size=m.v.shape)
    i, x = np.array([0, 5, 9, 40]), draw.normal(size=4)
    pairs = sum(x[a] * x[b] * (m.v[i[a]] @ m.v[i[b]]) for a in range(4) for b in range(a))
    want = 1 / (1 + np.exp(-(0.3 + m.w[i] @ x + pairs)))
    assert m.forward(quality.Rows(i, x, np.array([0, 4])))[0][0] == pytest.approx(want)


def test_statistics():
    (w,) = pieces(["AB!! cd\ncd | x1", "", None, "r s t\nr s t\nr s t"])
    s = dict(zip(quality.STATS, quality.statistics(w).T))
    assert s["upper"][0] == pytest.approx(2 * 2 / 11) and s["bar"][0] == pytest.approx(10 / 11)
    assert s["repeated_lines"].tolist() == [0, 0, 0, pytest.approx(2 / 3)] and s["repeated_words"][3] == pytest.approx(6 / 9)
    assert np.isfinite(quality.statistics(w)).all()


def test_the_sample_is_bounded(spark, docs):
    """One labelled id on many rows, and more labels than the sample takes."""
    from pyspark.sql import functions as F

    pairs = [(1, f"word{i} again", "a") for i in range(300)] + [(i, f"text {i} of five words", "a") for i in range(2, 40)]
    lab = labels(spark, [(i, i % 2, i % 2) for i in range(40)] + [(1, 1, 1)])

    def taken(most, most_bytes):
        out = toxicity.examples(docs(pairs), lab, "toxic", F.lit(True), "doc_id", "text", most, most_bytes, toxicity._featurise, "features").collect()
        assert all(set(r.asDict()) == {"row", "label", "place", "features"} for r in out)
        return len(out), sum(len(r.features) for r in out)

    assert taken(10, 1 << 20)[0] == 10
    assert taken(10_000, 1 << 20)[0] == 2 * 300 + 38
    assert 0 < taken(10_000, 400)[1] <= 400
    assert taken(0, 400) == (0, 0) == taken(10, 0)
    for run in (toxicity.toxicity, quality.quality):
        assert run(docs(pairs), lab, sample=7).count() == len(pairs)


def test_ftrl_equals_the_plain_form():
    """Coordinate by coordinate, as in the published algorithm."""
    draw = np.random.default_rng(2)
    rows = [(np.unique(draw.integers(0, 40, draw.integers(0, 9))), int(draw.random() < 0.4)) for _ in range(300)]
    model, z, n = toxicity.Ftrl(1.5, 6), {}, {}
    b = 1 << 6
    rate = lambda k: (toxicity.BETA + np.sqrt(n.get(k, 0.0))) / toxicity.ALPHA

    def weight(k):
        if k == b:
            return toxicity.PRIOR - z.get(k, 0.0) / rate(k)
        v = z.get(k, 0.0)
        return 0.0 if abs(v) <= 1.5 else -(v - np.sign(v) * 1.5) / (rate(k) + toxicity.L2)

    for index, label in rows:
        model.learn(index, label)
        ks = [*index.tolist(), b]
        w = {k: weight(k) for k in ks}
        g = (1 / (1 + np.exp(-sum(w.values()))) - label) * (toxicity.POSITIVE if label else 1.0)
        for k in ks:
            before = n.get(k, 0.0)
            n[k] = before + g * g
            z[k] = z.get(k, 0.0) + g - (np.sqrt(n[k]) - np.sqrt(before)) / toxicity.ALPHA * (w[k] - (toxicity.PRIOR if k == b else 0.0))
    at, w, bias = model.model()
    want = {k: weight(k) for k in range(b) if weight(k)}
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(want, rel=1e-4) and 3 < len(want) < 40
    assert bias == pytest.approx(weight(b))


def test_fit_equals_plain_adagrad_over_pairs(monkeypatch):
    """Gradients of the pairwise sum, one product after the other."""
    draw = np.random.default_rng(4)
    lists = [(np.sort(draw.choice(6, draw.integers(1, 5), False)), draw.integers(0, 2)) for _ in range(20)]
    xs = [draw.normal(size=len(i)) for i, _ in lists]
    marks = np.array([y for _, y in lists])
    monkeypatch.setattr(quality, "BATCH", 7)
    m = quality.Machine(0.2)
    w, v = m.w.copy(), m.v.copy()
    m.fit(quality.Rows(np.concatenate([i for i, _ in lists]), np.concatenate(xs), np.concatenate([[0], np.cumsum([len(x) for x in xs])])), marks, epochs=3)
    gw, gv = np.full(len(w), 1e-6), np.full(v.shape, 1e-6)
    order = np.random.default_rng(6)
    for _ in range(3):
        deal = order.permutation(len(marks))
        for a in range(0, len(deal), 7):
            pick = deal[a : a + 7]
            dw, dv = {}, {}
            for r in pick:
                (i, _), x = lists[r], xs[r]
                total = 0.2 + sum(w[a] * p for a, p in zip(i, x)) + sum(p * q * (v[a] @ v[b]) for k, (a, p) in enumerate(zip(i, x)) for b, q in zip(i[:k], x[:k]))
                g = (1 / (1 + np.exp(-total)) - marks[r]) / len(pick)
                for a, p in zip(i, x):
                    dw[a] = dw.get(a, 0) + g * p
                    dv[a] = dv.get(a, 0) + g * p * sum((q * v[b] for b, q in zip(i, x) if b != a), np.zeros(quality.RANK))
            for a in dw:
                one, many = dw[a] + quality.DECAY * w[a], dv[a] + quality.DECAY * v[a]
                gw[a] += one * one
                gv[a] += many * many
                w[a] -= quality.RATE * one / np.sqrt(gw[a])
                v[a] = v[a] - quality.RATE * many / np.sqrt(gv[a])
    assert m.w[:6] == pytest.approx(w[:6]) and m.v[:6] == pytest.approx(v[:6])
