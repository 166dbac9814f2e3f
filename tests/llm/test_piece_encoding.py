import random
import sys

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quern.llm import piece_encoding
from quern.llm._kept import Kept
from quern.llm.piece_encoding import IDS, Pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return Pieces(MODEL)


def packed(ids):
    return np.array(ids, IDS).tobytes()


def texts(n, seed=5):
    r = random.Random(seed)
    parts = ["ab cd", "  ", "\n", "é", "中文", "日", "don't", "x1 23", "▁", "\0", "\U0001f600", "the", "ing", " " * 37, "_x(", "://", "ﬁ", "한국", "a" * 40, "²³x½", "<s>", "<0x41>", "﷽", "á"]
    for _ in range(n):
        yield "".join(r.choice(parts) if r.random() < 0.6 else chr(r.choice([r.randrange(32, 127), r.randrange(97, 123), r.randrange(160, 1500), r.randrange(0x4E00, 0x4F00)])) for _ in range(r.randrange(12)))


def test_ids_and_texts_are_the_librarys(own, library):
    for t in texts(4000):
        ids = library.encode(t, add_bos=True, add_eos=True)
        assert own.encode(t) == packed(ids), t
        assert own.decode(packed(ids)) == library.decode(ids), t


def test_decoding_of_any_ids(own, library):
    r = random.Random(2)
    for _ in range(4000):
        ids = [r.randrange(1, 300) if r.random() < 0.5 else r.randrange(1, 32000) for _ in range(r.randrange(8))]
        assert own.decode(packed(ids)) == library.decode(ids), ids
    with pytest.raises(ValueError):
        own.decode(packed([32000]))


def test_long_texts_without_spaces(own, library):
    r = random.Random(3)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "的一是不了在人有我", "aàáâ", "▁", "0123456789", "!?.,"):
        t = "".join(r.choice(letters) for _ in range(20_000))
        assert own.encode(t) == packed(library.encode(t, add_bos=True, add_eos=True))


def test_places_are_given_up(own):
    """Some text needs the bitfield: its first longest pieces lead nowhere."""
    taken = []
    for t in texts(300, seed=9):
        spaced = "▁" + t.replace(" ", "▁")
        greedy, at = [], 0
        while at < len(spaced):
            n = max((n for n in range(1, 17) if spaced[at : at + n] in own.scores), default=1)
            greedy.append(spaced[at : at + n])
            at += n
        taken.append([own.pieces[i] if i >= 0 else None for i in own.split(spaced)] != greedy)
    assert any(taken)


def test_rows(spark, docs, edges, library):
    got = piece_encoding.encode(docs(edges), MODEL).collect()
    want = [(i, packed(library.encode(t or "", add_bos=True, add_eos=True))) for i, t, _ in edges]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=str) == sorted(want, key=str)
    back = piece_encoding.decode(piece_encoding.encode(docs(edges), MODEL), MODEL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back) == sorted((i is None, i or 0, t or "") for i, t, _ in edges)


def test_empty_table_and_null_ids(spark, docs):
    assert piece_encoding.encode(docs([]), MODEL).collect() == []
    none = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(None).cast("binary").alias("ids"))
    assert [tuple(r) for r in piece_encoding.decode(none, MODEL).collect()] == [(0, None)]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.byte_fallback = False
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        Pieces(str(path))


def test_kept_bytes_are_bounded():
    kept = Kept(lambda t: t.encode() * 3, most_bytes=50_000)
    for i in range(20_000):
        assert kept[f"piece {i % 3000}"] == f"piece {i % 3000}".encode() * 3
        assert kept["x" * 100 + str(i)] == ("x" * 100 + str(i)).encode() * 3
        assert sum(sys.getsizeof(k) + sys.getsizeof(v) for d in (kept, kept.older) for k, v in d.items()) <= 100_000
    assert not any(len(k) > 64 for d in (kept, kept.older) for k in d)
