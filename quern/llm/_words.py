"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a longest run of ASCII letters, digits and bytes of non-ASCII
characters; A-Z count as a-z. In code points: [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+
of the text with A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of a piece's size are kept."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, CHUNK_BYTES + 4096)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    tables = []
    for factor in (_BASE, inverse):
        table = np.full(size, factor, np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    if n <= CHUNK_BYTES + 4096:
        _powers[:] = tables
    return tables[0], tables[1]


class Words:
    """lower: bytes with A-Z lowered; start, end: byte range of each word;
    hash: 64 bits of each word; ptr: words of text i are ptr[i]:ptr[i+1];
    offsets: bytes of text i are offsets[i]:offsets[i+1] of raw."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        n = len(raw)
        self.lower = _LOWER[raw]
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = _IS_WORD[raw]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        here, before = inside[1:], inside[:-1]
        self.start = np.flatnonzero(here[:n] & (~before[:n] | first[:n]))
        self.end = np.flatnonzero(before & (~here | first)) if n else self.start
        self.ptr = np.searchsorted(self.start, offsets)
        up, down = _power_tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.lower.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + length)

    def __len__(self) -> int:
        return len(self.ptr) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def owners(self) -> np.ndarray:
        """The text's index, for each word."""
        return np.repeat(np.arange(len(self)), self.counts)


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Rows in pieces of about CHUNK_BYTES of text, with their words. A longer text
    is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offsets = column_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), Words(raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words and the index of each one's text. A text of
    fewer words, but not none, has one n-gram of all its words."""
    h, counts = words.hash, words.counts
    total = len(h)
    out = np.zeros(total, np.uint64)
    left = np.zeros(total, np.int64)
    if total:
        left = words.ptr[1:].repeat(counts) - np.arange(total)
    span = np.minimum(n, left)
    for k in range(n):
        there = np.arange(total) + k
        ok = k < span
        there[~ok] = 0
        out = np.where(ok, mix(out * np.uint64(31) + h[there] + np.uint64(k + 1)), out)
    position = np.arange(total) - words.ptr[:-1].repeat(counts)
    keep = (left >= n) | (position == 0)
    return out[keep], words.owners()[keep]
