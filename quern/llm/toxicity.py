"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

A text's features are the distinct hashes of its words, of pairs of neighbours and
of skip-grams (words with one between). FTRL-proximal keeps a learning rate for
each coordinate and drives weights that do not matter to zero, so a model is a
short list of (index, weight), at most 2**BITS of them, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import leaving, materialize, small_batches, trimmed
from ._words import Words, chunks, mix

BITS = 20
SAMPLE = 20_000  # labelled rows that a model is fitted on, at most
SAMPLE_BYTES = 100 << 20  # and bytes of their features
EPOCHS = 5
ALPHA, BETA, L2 = 5.0, 1.0, 1.0
L1_LEAST, L1_ROWS = 12.0, 800  # L1 grows with the examples, by one for so many
POSITIVE = 4.0  # an example of label 1 counts as so many
FOLDS, HELD_OUT = 5, 0
PRIOR = -2.4  # the bias before any label is seen: a score of 0.083


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Index and text of every word, pair and skip-gram, repeats included."""
    h, owner = words.hash, words.owners()
    out, own = [h], [owner]
    for gap, salt in ((1, 0x51), (2, 0xA3)):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            out.append(mix(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(salt))[same])
            own.append(owner[gap:][same])
    return (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(own)


def distinct(index: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((owner << BITS) | index)
    return key & ((1 << BITS) - 1), key >> BITS


class Ftrl:
    """Per-coordinate FTRL-proximal on rows of distinct feature indices."""

    def __init__(self, l1: float = L1_LEAST, bits: int = BITS):
        self.l1 = l1
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.bias = 1 << bits  # the last coordinate, without L1

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias_weight(self) -> float:
        return PRIOR - self.z[self.bias] / ((BETA + np.sqrt(self.n[self.bias])) / ALPHA)

    def learn(self, i: np.ndarray, label: int) -> None:
        w, b = self.weights(i), self.bias_weight()
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35)))
        g = (p - label) * (POSITIVE if label else 1.0)
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA
        self.z[i] += g - step * w
        self.n[i] += g * g
        k = self.bias
        step = (np.sqrt(self.n[k] + g * g) - np.sqrt(self.n[k])) / ALPHA
        self.z[k] += g - step * (b - PRIOR)
        self.n[k] += g * g

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        w = self.weights(slice(0, self.bias))
        at = np.flatnonzero(w)
        return at.astype(np.int32), w[at].astype(np.float32), float(self.bias_weight())


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, words in chunks(batches):
        index, owner = distinct(*features(words))
        cuts = np.searchsorted(owner, np.arange(len(words) + 1))
        blobs = [index[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([rows["label"], rows["place"], pa.array(blobs, pa.binary())], ["label", "place", "features"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for b in batches:
        # Views of the batch's buffer, not copies.
        views = [np.frombuffer(c.as_buffer(), "<u4") if len(c.as_buffer()) else np.zeros(0, "<u4") for c in b["features"]]
        rows += zip(b["place"].to_pylist(), b["row"].to_pylist(), b["label"].to_pylist(), views)
    rows.sort(key=lambda r: r[:3])
    model = Ftrl(max(L1_LEAST, len(rows) / L1_ROWS))
    for _ in range(EPOCHS):
        for *_, label, index in rows:
            model.learn(index, label)
    at, w, bias = model.model()
    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((at.tobytes(), pa.binary()), (w.tobytes(), pa.binary()), (bias, pa.float64()))], ["at", "w", "bias"])


def examples(df: DataFrame, labels: DataFrame, label: str, in_fold: Column, id_col: str, text_col: str, most: int, most_bytes: int, featurise: Callable, columns: str) -> DataFrame:
    """place, row, label and columns (binary, by featurise) of labelled rows: the first
    by a hash of the id, then by place in df, up to `most` rows and most_bytes in all.

    Rows with a null id or label are no examples; a label other than 0 counts as 1.
    An id that labels or df have several times gives an example each time, within the
    bounds. What meets in one task are bounded rows of three numbers.
    """
    picked = labels.where(in_fold & F.col(label).isNotNull() & F.col(id_col).isNotNull())
    picked = picked.select(F.col(id_col).alias("__id"), (F.col(label) != 0).cast("int").alias("label"), F.xxhash64(F.lit(11), F.col(id_col).cast("string")).alias("place"))
    picked = materialize(picked.orderBy("place", "__id", "label").limit(most), "sample")  # at most `most` small rows: broadcast
    texts = df.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select("label", "place", "text")
    made = texts.mapInArrow(trimmed(featurise), f"label int, place long, {', '.join(f'{c} binary' for c in columns.split())}")
    made = materialize(made.withColumn("row", F.monotonically_increasing_id()), "examples")
    size = sum((F.length(c) for c in columns.split()), F.lit(0).cast("long"))
    first = made.select("place", "row", size.alias("size")).orderBy("place", "row").limit(most)
    so_far = F.sum("size").over(Window.orderBy("place", "row").rowsBetween(Window.unboundedPreceding, 0))
    first = materialize(first.withColumn("so_far", so_far).where(F.col("so_far") <= most_bytes).select("row"), "sample")
    return made.join(F.broadcast(first), "row")


def fit(df: DataFrame, labels: DataFrame, label: str = "toxic", in_fold: Column | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, np.ndarray, float]:
    """(index, weight, bias) fitted on at most `sample` labelled rows of in_fold with
    at most sample_bytes of features (see examples), in one task that holds just them.
    Without any, no feature counts and the bias is PRIOR."""
    spark = df.sparkSession
    small_batches(spark)
    in_fold = in_fold if in_fold is not None else F.lit(True)
    with leaving(spark):
        rows = examples(df, labels, label, in_fold, id_col, text_col, sample, sample_bytes, _featurise, "features")
        got = rows.repartition(1).mapInArrow(trimmed(_train), "at binary, w binary, bias double").collect()
    if not got:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), PRIOR
    return np.frombuffer(got[0].at, np.int32), np.frombuffer(got[0].w, np.float32), got[0].bias


def scorer(model) -> Callable[[Words], np.ndarray]:
    """Scores of the texts of a piece, between 0 and 1."""
    at, w, bias = model
    table = np.zeros(1 << BITS, np.float32)
    table[at] = w

    def score(words: Words) -> np.ndarray:
        index, owner = features(words)
        counts = table[index] != 0
        index, owner = distinct(index[counts], owner[counts])
        total = np.bincount(owner, table[index].astype(np.float64), len(words)) + bias
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))

    return score


def score(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score for every row of df, over its whole text (null: empty)."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = scorer(shared.value)
        for rows, words in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows["id"], pa.array(f(words))], ["id", "score"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(run), f"id {kind}, score double").select(F.col("id").alias(id_col), "score")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """id_col, held_out, score, predicted for every row of df; learned from rows of
    labels that are not held out. An empty table gives no rows, texts that are null,
    empty or without words get the bias's score; other columns are not read."""
    model = fit(df, labels, "toxic", fold(id_col, FOLDS) != HELD_OUT, id_col, text_col, sample)
    out = score(df, model, id_col, text_col)
    return out.select(id_col, (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(df: DataFrame, model, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of df, all columns, that score less than `most`. No other row goes."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = scorer(shared.value)
        for rows, words in chunks(batches, text_col):
            yield rows.filter(pa.array(f(words) < most))

    return df.mapInArrow(trimmed(run), df.schema)
