"""Approximate search of short patterns in long texts, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST = 60  # letters of a pattern: a bit each in a long
HITS = "array<struct<end:int,distance:int>>"
CELLS = 1 << 20  # letters, filling among them, that are searched at once; a longer text goes alone


def _searched(texts: list[str], patterns: Sequence[str], edits: int) -> list[list[list[tuple[int, int]]]]:
    """For each text and pattern the (end, distance) of its hits, by end.

    Myers' bit-parallel search: two numbers for each text and pattern hold by how much the
    distances of the pattern's beginnings rise and fall, so a letter of all texts costs a
    few operations whatever the patterns' lengths."""
    found: list[list[list[tuple[int, int]]]] = [[[] for _ in patterns] for _ in texts]
    lengths = np.array([len(t) for t in texts])
    letters = np.array(sorted({ord(c) for p in patterns for c in p}), dtype=np.uint32)
    places = np.array([[sum(1 << i for i, c in enumerate(p) if ord(c) == x) for p in patterns] for x in letters] + [[0] * len(patterns)], dtype=np.int64)
    every = np.array([[(1 << len(p)) - 1] for p in patterns], dtype=np.int64)
    high = np.array([[len(p) - 1] for p in patterns], dtype=np.int64)
    codes = np.full((len(texts), lengths.max()), len(letters), dtype=np.int16)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    near = np.minimum(np.searchsorted(letters, flat), len(letters) - 1)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = np.where(letters[near] == flat, near, len(letters))
    up, down = np.repeat(every, len(texts), 1), np.zeros((len(patterns), len(texts)), dtype=np.int64)
    score = np.repeat(high + 1, len(texts), 1)
    for at in range(codes.shape[1]):
        eq = places[codes[:, at]].T
        across = ((((eq & up) + up) ^ up) & every) | eq
        xv, ph, mh = eq | down, down | (~(across | up) & every), up & across
        score += ((ph >> high) & 1) - ((mh >> high) & 1)
        ph, mh = (ph << 1) & every, (mh << 1) & every
        up, down = mh | (~(xv | ph) & every), ph & xv
        for p, t in zip(*np.nonzero((score <= edits) & (lengths > at))):
            found[t][p].append((at + 1, int(score[p, t])))
    return found


def hits_in(texts: Sequence[str | None], patterns: Sequence[str], edits: int) -> Iterator[tuple[int, list[list[tuple[int, int]]]]]:
    """(number of the text, hits by pattern) of texts that aren't null, those of like length together."""
    order = sorted((i for i, t in enumerate(texts) if t is not None), key=lambda i: len(texts[i]))
    while order:
        take = 1
        while take < len(order) and (take + 1) * len(texts[order[take]]) <= CELLS:
            take += 1
        some, order = order[:take], order[take:]
        yield from zip(some, _searched([texts[i] for i in some], patterns, edits))


def checked(patterns: Sequence[str]) -> None:
    if not all(0 < len(p) <= LONGEST for p in patterns):
        raise ValueError(f"a pattern has 1 to {LONGEST} letters")


def approximate_hits(text: Column, pattern: str, edits: int) -> Column:
    """Where pattern ends in text with at most `edits` edits: an array of end (letters up
    to there) and distance (the least edits of any part of text that ends there), by end.
    Letters are compared as they are. A null text gives null, an empty one no hits."""
    checked([pattern])

    @F.pandas_udf(HITS)
    def found(s: pd.Series) -> pd.Series:
        out = [None] * len(s)
        for i, (hits,) in hits_in(s.tolist(), [pattern], edits):
            out[i] = [{"end": e, "distance": d} for e, d in hits]
        return pd.Series(out, dtype=object)

    return found(text)


def best_hits(hits: list[tuple[int, int]], apart: int) -> list[tuple[int, int]]:
    """Of hits (end, distance), by end, less than `apart` letters from each other the best:
    those without a better one near, or an equal one before."""
    kept, low = [], 0
    for k, (end, distance) in enumerate(hits):
        while hits[low][0] <= end - apart:
            low += 1
        better = any(d <= distance for _, d in hits[low:k])
        after = k + 1
        while not better and after < len(hits) and hits[after][0] < end + apart:
            better, after = hits[after][1] < distance, after + 1
        if not better:
            kept.append((end, distance))
    return kept
