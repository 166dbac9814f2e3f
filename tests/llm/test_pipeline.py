import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from quern.llm import queries, toxicity

from .test_decontam import brute as contaminated
from .test_near_dedup import brute as classes
from .test_near_dedup import star

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage gets and those that it returns."""
    at, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{D}/documents.parquet"), []
    for name, f in cp.STAGES:
        got = f(spark, docs, D)
        got.write.parquet(f"file://{at}/{name}")
        after = spark.read.parquet(f"file://{at}/{name}")
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    assert all(set(s[3]) == set(cp.COLUMNS) for s in stages[:-1])


def test_toxicity(spark, stages):
    before, after = stages[0][1:3]
    scores = toxicity.toxicity(spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")).collect()
    assert ids(after) == Counter(r.doc_id for r in scores if not r.predicted)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_near_dedup(stages):
    before, after = stages[1][1:3]
    of = dict(zip([r.doc_id for r in before], classes([(r.doc_id, r.text, "") for r in before])))
    assert Counter(of[r.doc_id] for r in after) == Counter(set(of.values()))


def test_near_dedup_of_a_large_group(spark):
    """500 copies that are alike through their base only: one document stays."""
    rows = [(i, t, "en", s, len(t)) for i, t, s in star(500, random.Random(2))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert len(set(classes([(r[0], r[1], "") for r in rows]))) == 1
    assert cp.near_duplicates(spark, df, D).count() == 1


def test_decontamination(spark, stages):
    before, after = stages[2][1:3]
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    assert ids(after) == Counter(x[0] for x in contaminated([(r.doc_id, r.text, "") for r in before], items).elements() if not x[5])


def test_mixing(stages):
    before, after = stages[3][1:3]
    n = ids(after)
    assert set(n) <= set(ids(before)) and max(n.values()) <= 2
    size = {r.doc_id: len(r.text.split()) for r in before}
    total = sum(size.values())
    assert abs(sum(size[i] * k for i, k in n.items()) - 1.5 * total) <= 20 * max(size.values())
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_tokens(stages):
    from tokenizers import Tokenizer

    before, after = stages[4][1:3]
    t = Tokenizer.from_file(queries.word_tokenizer())
    want = Counter((r.doc_id, zlib.crc32(np.array(t.encode(r.text, add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in before)
    assert Counter((r.doc_id, r.ids_crc32) for r in after) == want
    starts = sorted((r.start, r.n_tokens, r.doc_id) for r in after)
    assert [r[0] for r in starts] == [0, *np.cumsum([r[1] for r in starts])[:-1]] and [r[2] for r in starts] == sorted(r[2] for r in starts)


def test_edges(spark, edges, tmp_path):
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in edges]
    for name, data in (("edges", rows), ("none", [])):
        d = f"file://{tmp_path}/{name}"
        spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        assert (cp.run(spark, d).count() > 0) == bool(data)


def test_results_of_two_runs_stay_readable(spark):
    first, second = cp.run(spark, D), cp.run(spark, D)
    a, b = (sorted(map(str, x.collect())) for x in (first, second))
    assert a == b and a


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from quern.llm import _shared

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError):
            _shared.shared_dir(session)
