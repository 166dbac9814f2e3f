"""Token ids in Arrow files of equal-length sequences.

A store is a folder of shards in ascending order of document id. A shard is two
Arrow IPC files: shard-N.arrow holds record batches of fixed-size lists, input_ids
and mask, each list a sequence of seq_len ids of the shard's documents one after
the other (the last one is padded, mask false); shard-N.docs.arrow holds doc_id,
start and n_tokens of its documents. Sequence k of a shard is slot k % SEQS_A_BATCH
of batch k // SEQS_A_BATCH, so a memory map gives any sequence, and its mask, without
a copy. Masks are Arrow booleans, a bit each: a byte each would make files half as
large again.
"""

from __future__ import annotations

import contextlib
import gc
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._kept import Kept
from ._shared import new_path, partitions, small_batches, trimmed

SEQ_LEN = 2048
SEQS_A_BATCH = 64
KEPT_BYTES = 14 << 20  # of pieces' ids; as much for those kept before them, and both again for words of simple texts. They stay with the worker
# The parts of a tokenizers file under which pieces can be encoded alone.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
WORD_END = "</w>"
# Line ends, printable ASCII and the letters of Latin-1: normal forms of themselves.
_SIMPLE = re.compile("[\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \na-z0-9ß-öø-ÿ]+")
# Byte-level tokenizers write a byte that is no visible character of Latin-1 as 256 + its rank among those.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_BYTES = {b: 256 + k for k, b in enumerate(_HIDDEN)}
_SPACES = str.maketrans({"\n": " ", "\t": " ", "\r": " "})


class Encoder:
    """Ids of texts by a tokenizers file, special tokens not added.

    Where the tokenizer drops white space between words and marks word ends, a text
    is cut where it cuts it and each piece is encoded by the library once, then kept.
    Texts of simple characters are cut into its words, others at white space of ASCII
    only. Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_pieces = (spec.get("normalizer"), spec.get("pre_tokenizer"), spec["model"].get("end_of_word_suffix")) == (NORMALIZER, PRE_TOKENIZER, WORD_END)
        self.words, self.others = Kept(self._word, KEPT_BYTES), Kept(self._ids, KEPT_BYTES)
        self.tokenize, self.code = self.tokenizer.model.tokenize, self.dtype.char

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        """A word of a simple text needs nothing but the library's model."""
        return array(self.code, [t.id for t in self.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text the bytes of its ids."""
        if not self.by_pieces:
            return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        word, other = self.words.__getitem__, self.others.__getitem__
        return [b"".join(map(word, _PIECE.findall(t.lower())) if _SIMPLE.fullmatch(t) and "<|" not in t else map(other, t.translate(_SPACES).split(" "))) for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if urlparse(path).scheme else (pafs.LocalFileSystem(), path)


def _put(fs: pafs.FileSystem, paths: list[str], write: Callable) -> None:
    """Write files aside and rename them: a task that is lost or runs twice leaves
    whole files with the same content."""
    aside = [f"{p}.{uuid.uuid4().hex}.tmp" for p in paths]
    with contextlib.ExitStack() as open_files:
        write(*[open_files.enter_context(fs.open_output_stream(a)) for a in aside])
    for a, p in zip(aside, paths):
        fs.move(a, p)


class _Shard:
    """Gathers ids; whole batches of sequences go to the file as they fill."""

    def __init__(self, sink, dtype: np.dtype, seq_len: int):
        self.n, self.size = seq_len, seq_len * SEQS_A_BATCH
        self.kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(self.kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.dtype, self.rest, self.writer = dtype, b"", pa.ipc.new_file(sink, self.schema)

    def add(self, ids: bytes) -> None:
        data, at, step = memoryview(self.rest + ids), 0, self.size * self.dtype.itemsize
        while len(data) - at >= step:
            self._batch(np.frombuffer(data[at : at + step], self.dtype), self.size)
            at += step
        self.rest = bytes(data[at:])

    def _batch(self, ids: np.ndarray, real: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(x, self.n) for x in (pa.array(ids), pa.array(np.arange(len(ids)) < real))]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.rest:
            ids = np.frombuffer(self.rest, self.dtype)
            self._batch(np.concatenate([ids, np.zeros(-len(ids) % self.n, self.dtype)]), len(ids))
        self.writer.close()


def _writer(out: str, path: str, end_id: int, seq_len: int, id_type: pa.DataType) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard = encoder(path), TaskContext.get().partitionId()
        fs, folder = _filesystem(out)
        fs.create_dir(folder)
        end = np.array([end_id], enc.dtype).tobytes()
        index = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        docs = tokens = 0

        def both(ids_sink, docs_sink) -> None:
            nonlocal docs, tokens
            file, table = _Shard(ids_sink, enc.dtype, seq_len), pa.ipc.new_file(docs_sink, index)
            for batch in batches:
                counts = []
                for at in range(0, batch.num_rows, 64):
                    encoded = enc.encode([t or "" for t in batch.column(1).slice(at, 64).to_pylist()])
                    counts += [len(e) // enc.dtype.itemsize + 1 for e in encoded]
                    file.add(b"".join(e + end for e in encoded))
                n = np.array(counts, np.int64)
                table.write_batch(pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(tokens + np.cumsum(n) - n), pa.array(n)], schema=index))
                docs, tokens = docs + len(counts), tokens + int(n.sum())
            file.close()
            table.close()

        gc.disable()  # lists of many pieces, without cycles
        try:
            _put(fs, [f"{folder}/shard-{shard:06d}.arrow", f"{folder}/shard-{shard:06d}.docs.arrow"], both)
        finally:
            gc.enable()
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, docs, tokens)], ["shard", "docs", "tokens"])

    return write


def write_tokens(df: DataFrame, tokenizer: str, end_id: int = 1, seq_len: int = SEQ_LEN, id_col: str = "doc_id", text_col: str = "text", out: str | None = None) -> tuple[str, list]:
    """Write df's texts as a store; its folder, and for each shard (shard, docs, tokens).

    Rows are dealt by ranges of id and sorted by id (null first), then text: rows that
    repeat are documents of their own, next to each other. Ids keep their own type. A
    null text is empty: its document is the end id alone. What comes to the driver is
    one small row a shard. An empty table gives a store without documents. Other
    columns of df are not read. A very long text is encoded as a whole; a batch of 64
    texts must fit in a worker's memory, all else that a task holds is bounded.
    """
    spark = df.sparkSession
    small_batches(spark)
    out = out or new_path(spark, "tokens")
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    shards = dealt.mapInArrow(trimmed(_writer(out, tokenizer, end_id, seq_len, to_arrow_type(rows.schema["doc_id"].dataType))), "shard long, docs long, tokens long").collect()
    return out, sorted(tuple(r) for r in shards if r.docs)


def open_store(path: str):
    """An IPC file reader; on a local path over a memory map. The file of a shard
    without documents has no batches; a path that isn't there raises FileNotFoundError."""
    fs, name = _filesystem(path)
    return pa.ipc.open_file(pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name))


def sequence(reader, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of sequence k of a shard, both views of the file: numpy has no
    arrays of bits, so the mask stays an Arrow array (to_numpy(False) copies it). All
    but a shard's last sequence have a mask of ones; a k that the shard doesn't have
    raises IndexError."""
    at, j = divmod(k, SEQS_A_BATCH)
    if not 0 <= at < reader.num_record_batches:
        raise IndexError(k)
    ids, mask = reader.get_batch(at).columns
    if j >= len(ids):
        raise IndexError(k)
    n = ids.type.list_size
    return ids.values.slice(j * n, n).to_numpy(), mask.values.slice(j * n, n)


def _reader(out: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{out}/shard-{shard:06d}"
                docs, ids = open_store(f"{name}.docs.arrow"), open_store(f"{name}.arrow")
                part, at, following = np.zeros(0, np.uint32), 0, 0  # a batch of ids and where it begins
                for d in range(docs.num_record_batches):
                    rows = docs.get_batch(d)
                    starts, sizes = rows.column("start").to_numpy(), rows.column("n_tokens").to_numpy()
                    crc = np.zeros(len(starts), np.int64)
                    for i, (lo, end) in enumerate(zip(starts.tolist(), (starts + sizes).tolist())):
                        seen = 0
                        while lo < end:
                            while lo >= at + len(part):
                                at += len(part)
                                part, following = ids.get_batch(following).column(0).values.to_numpy(), following + 1
                            piece = part[lo - at : end - at]
                            seen = zlib.crc32(piece.astype("<u4").tobytes(), seen)
                            lo += len(piece)
                        crc[i] = seen
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(starts + base), pa.array(sizes), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_tokens(spark: SparkSession, out: str, shards: list, id_type: str = "long") -> DataFrame:
    """doc_id (of id_type), start, n_tokens, ids_crc32 of every document, read from the
    files; start counts the ids of all documents before it in the store. Null ids stay
    null, repeated ones are a row each; a store without shards gives no rows."""
    rows, base = [], 0
    for shard, _, tokens in shards:
        rows.append((shard, base))
        base += tokens
    each = spark.createDataFrame(rows, "shard long, base long").repartition(max(1, len(rows)))
    return each.mapInArrow(_reader(out), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
