"""Quality classifier: a factorisation machine.

Inputs are hashed words (their counts, scaled to length 1), statistics of the text's
structure, and its lengths as metadata. The machine adds to a linear score all
pairwise interactions of inputs with low-rank weights, in time linear in the inputs:
sum over f of ((sum_i v_if x_i)**2 - sum_i (v_if x_i)**2) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import leaving, small_batches, trimmed
from ._words import Words, chunks
from .toxicity import examples, fold

BITS = 15
RANK = 4
SAMPLE = 12_000  # labelled rows that a model is fitted on, at most
SAMPLE_BYTES = 32 << 20  # and bytes of their inputs
EPOCHS = 8
BATCH = 64
RATE, DECAY = 0.1, 1e-4
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
STATS = ("upper", "digit", "punctuation", "exclaim", "bar", "space", "line_ends", "not_ascii", "word_length", "long_words", "repeated_words", "repeated_lines", "log_words", "log_chars", "line_length", "markup", "one")
WORDS_AT = len(STATS)

_CLASS = np.zeros(256, np.uint8)  # a class of bytes for each statistic that counts bytes
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 3
_CLASS[ord("!")] = 4
_CLASS[[ord("|"), ord("\t")]] = 5
_CLASS[32] = 6
_CLASS[10] = 7
_CLASS[128:] = 8
_CLASS[[ord(c) for c in "<>{}[]=/\\#@*_&%$~^+`"]] = 9


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _distinct_share(owner: np.ndarray, key: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text the share of items that repeat an earlier one."""
    order = np.lexsort((key, owner))
    o, k = owner[order], key[order]
    again = np.zeros(len(k), bool)
    again[1:] = (o[1:] == o[:-1]) & (k[1:] == k[:-1])
    return _ratio(np.bincount(o[again], minlength=len(counts)), counts)


def statistics(words: Words) -> np.ndarray:
    """A row of STATS for each text."""
    n = len(words)
    sizes = np.diff(words.offsets)
    owner = np.repeat(np.arange(n), sizes)
    by_class = np.bincount(owner * 10 + _CLASS[words.raw], minlength=10 * n).reshape(n, 10).astype(np.float64)
    counts = words.counts
    length = (words.end - words.start).astype(np.float64)
    word_owner = words.owners()
    lines = by_class[:, 7] + (sizes > 0)
    ends = np.flatnonzero(words.raw == 10)
    # A line's key: the sum of its words' hashes in order of place, with wrap-around.
    line_of = np.searchsorted(ends, words.start) + word_owner
    keys = np.zeros(int(line_of[-1]) + 1 if len(line_of) else 0, np.uint64)
    place = np.arange(len(line_of)) - np.searchsorted(line_of, line_of) if len(line_of) else line_of
    np.add.at(keys, line_of, words.hash * (2 * place.astype(np.uint64) + np.uint64(1)))
    used = np.unique(line_of)
    used_owner = word_owner[np.searchsorted(line_of, used)]
    used_counts = np.bincount(used_owner, minlength=n)
    letters = np.maximum(sizes - by_class[:, 6] - by_class[:, 7], 1)
    columns = {
        "upper": by_class[:, 1] / letters * 2, "digit": by_class[:, 2] / letters * 4, "punctuation": by_class[:, 3] / letters * 6, "exclaim": by_class[:, 4] / letters * 10,
        "bar": by_class[:, 5] / letters * 10, "space": _ratio(by_class[:, 6], sizes) * 3, "line_ends": _ratio(by_class[:, 7], sizes) * 20, "not_ascii": by_class[:, 8] / letters * 2,
        "word_length": np.minimum(_ratio(np.bincount(word_owner, length, n), counts) / 10, 3), "long_words": _ratio(np.bincount(word_owner, length > 20, n), counts) * 5,
        "repeated_words": _distinct_share(word_owner, words.hash, counts), "repeated_lines": _distinct_share(used_owner, keys[used], used_counts),
        "log_words": np.log1p(counts) / 8, "log_chars": np.log1p(sizes) / 10, "line_length": np.log1p(_ratio(sizes, lines)) / 8, "markup": by_class[:, 9] / letters * 10, "one": np.ones(n),
    }
    return np.stack([np.minimum(columns[k], 4.0) for k in STATS], 1)


class Rows:
    """Sparse rows: values x of inputs i; row r has ptr[r]:ptr[r+1]."""

    def __init__(self, i: np.ndarray, x: np.ndarray, ptr: np.ndarray):
        self.i, self.x, self.ptr = i, x, ptr

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ptr[-1]) + np.repeat(self.ptr[rows] - ptr[:-1], sizes)
        return Rows(self.i[at], self.x[at], ptr)


def inputs(words: Words) -> Rows:
    stats = statistics(words)
    n = len(words)
    key, count = np.unique((words.owners() << BITS) | (words.hash >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    owner, index = key >> BITS, key & ((1 << BITS) - 1)
    value = np.log1p(count)
    value = value / np.sqrt(np.maximum(np.bincount(owner, value * value, n), 1e-9))[owner]
    every = np.concatenate([np.repeat(np.arange(n), WORDS_AT), owner])
    i = np.concatenate([np.tile(np.arange(WORDS_AT), n), index + WORDS_AT])
    x = np.concatenate([stats.ravel(), value])
    order = np.argsort(every, kind="stable")
    return Rows(i[order], x[order], np.searchsorted(every[order], np.arange(n + 1)))


class Machine:
    def __init__(self, bias: float = 0.0):
        draw = np.random.default_rng(5)
        size = WORDS_AT + (1 << BITS)
        self.bias, self.w = bias, np.zeros(size)
        self.v = draw.normal(0, 0.05, (size, RANK))

    def forward(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vx = self.v[rows.i] * rows.x[:, None]
        at = rows.ptr[:-1]  # no row is empty: "one" is always there
        sums = np.add.reduceat(vx, at)
        total = self.bias + np.add.reduceat(self.w[rows.i] * rows.x, at)
        total += 0.5 * (np.square(sums) - np.add.reduceat(np.square(vx), at)).sum(1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))), sums, vx

    def fit(self, rows: Rows, labels: np.ndarray, epochs: int = EPOCHS) -> Machine:
        """AdaGrad over small batches, in an order that a seed fixes."""
        draw = np.random.default_rng(6)
        gw, gv = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6)
        for _ in range(epochs):
            order = draw.permutation(len(labels))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                b = rows.take(pick)
                p, sums, vx = self.forward(b)
                g = ((p - labels[pick]) / len(pick)).repeat(np.diff(b.ptr))
                own = np.repeat(np.arange(len(pick)), np.diff(b.ptr))
                used, inverse = np.unique(b.i, return_inverse=True)
                dw = np.bincount(inverse, g * b.x, len(used)) + DECAY * self.w[used]
                each = (g * b.x)[:, None] * (sums[own] - vx)
                dv = np.stack([np.bincount(inverse, each[:, f], len(used)) for f in range(RANK)], 1) + DECAY * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                self.w[used] -= RATE * dw / np.sqrt(gw[used])
                self.v[used] -= RATE * dv / np.sqrt(gv[used])
        return self

    def dump(self) -> tuple[float, bytes, bytes]:
        return self.bias, self.w.astype("<f4").tobytes(), self.v.astype("<f4").tobytes()

    @classmethod
    def load(cls, bias: float, w: bytes, v: bytes) -> Machine:
        out = cls.__new__(cls)
        out.bias, out.w = bias, np.frombuffer(w, "<f4")
        out.v = np.frombuffer(v, "<f4").reshape(-1, RANK)
        return out


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, words in chunks(batches):
        x = inputs(words)
        parts = [(x.i[a:b].astype("<u4").tobytes(), x.x[a:b].astype("<f4").tobytes()) for a, b in zip(x.ptr, x.ptr[1:])]
        yield pa.RecordBatch.from_arrays([rows["label"], rows["place"], pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], ["label", "place", "i", "x"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for b in batches:
        rows += zip(*(b[k].to_pylist() for k in ("place", "row", "label", "i", "x")))
    rows.sort()
    if rows:
        i = [np.frombuffer(r[3], "<u4") for r in rows]
        x = np.concatenate([np.frombuffer(r[4], "<f4") for r in rows])
        ptr = np.concatenate([[0], np.cumsum([len(a) for a in i])])
        labels = np.array([r[2] for r in rows])
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        machine = Machine(float(np.log(share / (1 - share)))).fit(Rows(np.concatenate(i).astype(np.int32), x, ptr), labels)
    else:
        machine = Machine()
        machine.v[:] = 0
    yield pa.RecordBatch.from_arrays([pa.array([a], t) for a, t in zip(machine.dump(), (pa.float64(), pa.binary(), pa.binary()))], ["bias", "w", "v"])


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> tuple:
    """A machine (as of Machine.dump) fitted on at most `sample` labelled rows, none
    held out, with at most sample_bytes of inputs. Without any it gives every text 0.5."""
    spark = df.sparkSession
    small_batches(spark)
    with leaving(spark):
        rows = examples(df, labels, "quality", fold(id_col, FOLDS) != HELD_OUT, id_col, text_col, sample, sample_bytes, _featurise, "i x")
        got = rows.repartition(1).mapInArrow(trimmed(_train), "bias double, w binary, v binary").collect()
    return tuple(got[0]) if got else (0.0, np.zeros(WORDS_AT + (1 << BITS), "<f4").tobytes(), np.zeros((WORDS_AT + (1 << BITS)) * RANK, "<f4").tobytes())


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """id_col, held_out, score, predicted for every row of df, over its whole text
    (null: empty); learned from rows of labels that are not held out. An empty table
    gives no rows; other columns are not read."""
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(fit(df, labels, id_col, text_col, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.load(*model.value)
        for rows, words in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows["id"], pa.array(machine.forward(inputs(words))[0].astype(np.float64))], ["id", "score"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(trimmed(run), f"id {kind}, score double").select(F.col("id").alias(id_col), "score")
    return out.select(id_col, (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
