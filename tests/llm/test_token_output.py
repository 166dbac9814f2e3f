import zlib

import numpy as np
import pytest

from quern.llm import token_output as to
from quern.llm.queries import word_tokenizer

tokenizers = pytest.importorskip("tokenizers")


def plain(pairs):
    t = tokenizers.Tokenizer.from_file(word_tokenizer())
    keyed = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [1]) for i, x, _ in keyed]


def check(spark, df, pairs, seq_len):
    out, shards = to.write_tokens(df, word_tokenizer(), seq_len=seq_len)
    want = plain(pairs)
    got = sorted(to.read_tokens(spark, out, shards).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    at = 0
    by_id = {}
    for i, ids in want:
        by_id.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        by_id[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    return out, shards, want


def test_round_trip(spark, docs, edges):
    check(spark, docs(edges), edges, 16)
    check(spark, docs(edges), edges, to.SEQ_LEN)


def test_sequences_and_masks(spark, docs):
    pairs = [(i, "the cat's 12 sat " * (i % 50), "a") for i in range(300)]
    out, shards, want = check(spark, docs(pairs), pairs, 8)
    flat = [x for _, ids in want for x in ids]
    for shard, _, tokens in shards:
        file = to.open_store(f"{out}/shard-{shard:06d}.arrow")
        own, flat = flat[:tokens], flat[tokens:]
        for k in range(-(-tokens // 8)):
            ids, mask = to.sequence(file, k)
            assert len(ids) == len(mask) == 8 and ids[mask.to_numpy(False)].tolist() == own[8 * k : 8 * k + 8]
        with pytest.raises(IndexError):
            to.sequence(file, -(-tokens // 8))
    assert not flat


def test_sequences_and_masks_are_views(spark, docs):
    """Both point into the same mapped batch whenever they are asked for."""
    out, shards = to.write_tokens(docs([(i, "a b c d e f g h", "a") for i in range(200)]), word_tokenizer(), seq_len=8)
    file = to.open_store(f"{out}/shard-{shards[0][0]:06d}.arrow")
    (ids, mask), (again, mask_again) = to.sequence(file, 1), to.sequence(file, 1)
    assert ids.__array_interface__["data"][0] == again.__array_interface__["data"][0]
    assert not ids.flags.owndata and mask.buffers()[1].address == mask_again.buffers()[1].address


@pytest.mark.parametrize("kind", ["int", "string", "smallint"])
def test_ids_of_any_type(spark, kind):
    df = spark.createDataFrame([(i, f"text {i}") for i in (3, 1, 2)] + [(None, "no id")], "doc_id int, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    out, shards = to.write_tokens(df, word_tokenizer())
    got = to.read_tokens(spark, out, shards, kind).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, *[str(i) if kind == "string" else i for i in (1, 2, 3)]]


def test_empty_table(spark, docs):
    out, shards = to.write_tokens(docs([]), word_tokenizer())
    assert shards == [] and to.read_tokens(spark, out, shards).collect() == []


def test_pieces_give_the_tokenizers_own_ids():
    texts = ["don't  stop\tnow\r\n\x1c a\u0085b c 　x é ́y Σς ΑΣ <|endoftext|> <|startoftext|>x", "İstanbul ǅ ﬁ  z", " ", "", "I'll we've O'S it'T x'sy ''s A1b22 ÉCOLE straße ×÷ ÿ", "a,b!! |c| <|no", "x" * 500 + " ½²"]
    e = to.Encoder(word_tokenizer())
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_fixture_documents_match_the_library(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    e = to.Encoder(word_tokenizer())
    assert e.by_pieces
    assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)] == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(to, "KEPT_BYTES", 1000)
    e = to.Encoder(word_tokenizer())
    for t in ("a b c d e", "c d e f g", "a b c x y z", "c d"):
        assert np.frombuffer(e.encode([t])[0], e.dtype).tolist() == e.tokenizer.encode(t).ids
        assert len(e.words) + len(e.words.older) < 20


def test_long_pieces_are_not_kept():
    """Texts without spaces: nothing of them stays in a worker."""

    def resident():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) / 1024

    e, r = to.Encoder(word_tokenizer()), np.random.default_rng(1)
    e.encode(["\u7684" * 1600])
    before = resident()
    for _ in range(60):
        e.encode(["".join(map(chr, r.integers(0x4E00, 0x9FFF, 1600))) for _ in range(64)])
    assert not e.others and not e.words and resident() - before < 20


def test_a_long_text_goes_into_many_batches(spark, tmp_path):
    text = "word " * 700_000
    df = spark.createDataFrame([(1, text), (2, "b")], "doc_id long, text string")
    out, shards = to.write_tokens(df, word_tokenizer(), out=f"file://{tmp_path}/store")
    got = sorted(map(tuple, to.read_tokens(spark, out, shards).collect()))
    ids = to.Encoder(word_tokenizer()).tokenizer.encode(text).ids + [1]
    assert got[0] == (1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sum(to.open_store(f"{out}/shard-{s:06d}.arrow").num_record_batches for s, _, _ in shards) > 5
