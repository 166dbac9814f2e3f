"""Suffix-array dedup over a sparse suffix array.

Only suffixes that begin at a minimiser are kept: the place with the smallest hash
among MIN_WORDS - K + 1 neighbouring runs of K words. It depends on the words alone,
so any two copies of a passage of MIN_WORDS words keep a suffix at the same place of
it. The suffixes are sorted over the whole cluster by their first K words (as a
hash) and the words that follow, neighbours from different texts are compared, and
a match is extended word by word to the right and to the left. Suffixes with the same
K words that share MIN_WORDS words by others to the left are not neighbours: of each
the hashes of all windows of MIN_WORDS words around the K words are compared too. What
each suffix carries to the sort is the REACH words on either side of its K words, as
16 bits a word: a longer passage has more minimisers, and their matches are joined.
A passage's K words are compared by 63 bits; of the others, two that differ agree by
chance once in 65,536, so a passage's end is a word off as rarely as that.

A sorted part is gone through in pieces of PIECE suffixes, cut between keys where a key
is not larger than that. The windows of keys that a cut may divide are compared once
more over the cluster, so nothing depends on where parts or pieces end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize, partitions, small_batches, trimmed
from ._words import Words, chunks, mix

MIN_WORDS = 50
K = 10
PIECE = 50_000  # suffixes that a task holds at once, about 10 MB


def run_hashes(words: Words, k: int) -> np.ndarray:
    """A hash of each k consecutive words, and the largest number where a text has fewer left."""
    h = words.hash
    n = len(h)
    out = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[j : n - k + 1 + j]
        left = words.ptr[1:].repeat(words.counts)[: n - k + 1] - np.arange(n - k + 1)
        out[: n - k + 1] = np.where(left >= k, mix(acc) >> np.uint64(1), out[: n - k + 1])
    return out


def minimisers(words: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (word indices), and the hashes, of the smallest of each window of runs
    inside a text; of equal ones the first."""
    g = run_hashes(words, k)
    n = len(g)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Sliding minima over a power of two, then over two overlapping halves.
    low, width = g, 1
    while width * 2 <= window:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    rest = window - width
    low = np.minimum(low[: n - window + 1], low[rest : n - window + 1 + rest])
    start = np.arange(n - window + 1)
    end = words.ptr[1:].repeat(words.counts)[: n - window + 1]
    inside = start + window + k - 1 <= end
    start, low = start[inside], low[inside]
    if not len(start):
        return start, low
    # The first place at or after a window's start that has its minimum.
    order = np.argsort(g, kind="stable")
    ranked = g[order]
    rank = np.empty(n, np.int64)
    first = np.searchsorted(ranked, ranked)
    rank[order] = first
    combined = np.sort(rank * n + np.arange(n))
    value = np.searchsorted(ranked, low)
    at = combined[np.searchsorted(combined, value * n + start)] % n
    keep = np.unique(at)
    return keep, g[keep]


def _suffixes(k: int, least: int):
    window = least - k + 1
    reach = window - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in chunks(batches):
            at, g = minimisers(words, k, window)
            owner = np.searchsorted(words.ptr, at, side="right") - 1
            begin, end = words.ptr[owner], words.ptr[owner + 1]
            short = (words.hash >> np.uint64(48)).astype(">u2")
            padded = np.concatenate([np.zeros(reach, ">u2"), short, np.zeros(reach + k, ">u2")])
            n_left, n_right = np.minimum(at - begin, reach), np.minimum(end - at - k, reach)
            step = np.arange(reach)
            right = np.where(step < n_right[:, None], padded[at[:, None] + reach + k + step], 0).astype(">u2")
            left = np.where(step < n_left[:, None], padded[at[:, None] + reach - 1 - step], 0).astype(">u2")
            n = len(at)
            offsets = np.arange(n + 1, dtype=np.int32) * (2 * reach)
            cells = [pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(m))]) for m in (right, left)]
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), cells[0], cells[1], batch["id"].take(pa.array(owner)), batch["row"].take(pa.array(owner)), pa.array((at - begin).astype(np.int32)), pa.array(n_right.astype(np.int16)), pa.array(n_left.astype(np.int16))], ["key", "right", "left", "id", "row", "pos", "n_right", "n_left"])

    return run


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :]
    return np.frombuffer(column.buffers()[2], ">u2")[offsets[0] // 2 : offsets[0] // 2 + len(column) * width].reshape(len(column), width)


def _agree(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading cells of the rows agree, `most` at most."""
    differ = a != b
    n = np.where(differ.any(1), differ.argmax(1), a.shape[1])
    return np.minimum(n, most)


def _windows(key: np.ndarray, right: np.ndarray, left: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """For l = 0 ... reach a hash of l words to the left, the key and reach - l words to the right."""
    by = mix(np.arange(1, 2 * reach + 1, dtype=np.uint64)) | np.uint64(1)
    h = np.zeros(len(key), np.uint64)
    for j in range(reach):
        h += right[:, j].astype(np.uint64) * by[j]
    for l in range(reach + 1):
        yield l, mix(mix(key.view(np.uint64) + np.uint64(l)) + h)
        if l < reach:
            h += left[:, l].astype(np.uint64) * by[reach + l] - right[:, reach - 1 - l].astype(np.uint64) * by[reach - 1 - l]


def compare_windows(table: pa.Table, found: dict, k: int, least: int, reach: int, across: bool, cut: tuple[bool, bool]) -> tuple[dict, dict]:
    """Matches by windows of `least` words that those found leave out, and the windows
    (suffix, l, hash) of the first and the last key, where cut says that other pieces
    may have them too: all where one text has it, else those of two texts."""
    key, row = (table[c].to_numpy() for c in ("key", "row"))
    n = len(key)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    n_right, n_left = (table[c].to_numpy().astype(np.int64) for c in ("n_right", "n_left"))
    # Splits of a window that a match with the run before, or after, or the latest one here covers.
    low, high = np.full((3, n), reach + 1), np.full((3, n), -1)
    side = (found["j"] > found["i"]).astype(np.int64)
    low[side, found["i"]], high[side, found["i"]] = reach - found["r"], found["l"]
    whole = ((low <= np.maximum(0, reach - n_right)) & (high >= np.minimum(reach, n_left))).any(0)
    use = (sizes > 2) & ~np.logical_and.reduceat(whole, starts)
    use[0] |= cut[0]
    use[-1] |= cut[1]
    at = np.flatnonzero(np.repeat(use, sizes))
    border = ((key[at] == key[0]) & cut[0]) | ((key[at] == key[-1]) & cut[1])
    right, left = (_matrix(table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c], reach) for c in ("right", "left"))
    who = row[at] if across else at
    out, edge = {c: [] for c in ("i", "j", "l", "r")}, {c: [] for c in ("i", "l", "window")}
    for l, h in _windows(key[at], right[at], left[at], reach):
        ok = np.flatnonzero((l <= n_left[at]) & (reach - l <= n_right[at]))
        if not len(ok):
            continue
        ok = ok[np.lexsort((who[ok], h[ok]))]
        new = np.concatenate([[True], h[ok][1:] != h[ok][:-1]])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(ok)]]) - 1
        one = (who[ok[first]] == who[ok[last]])[group]
        here = np.arange(len(ok))
        send = border[ok] & (one | (here == first[group]) | (here == last[group]))
        edge["i"].append(at[ok[send]])
        edge["l"].append(np.full(np.count_nonzero(send), l))
        edge["window"].append(h[ok[send]].view(np.int64))
        partner = np.where(who[ok[first]][group] != who[ok], first[group], last[group])
        i, j = at[ok], at[ok[partner]]
        todo = ~one & ~((low[:, i] <= l) & (l <= high[:, i])).any(0)
        i, j = i[todo], j[todo]
        for a in range(0, len(i), 50_000):
            x, y = i[a : a + 50_000], j[a : a + 50_000]
            rr = _agree(right[x], right[y], np.minimum(n_right[x], n_right[y]))
            ll = _agree(left[x], left[y], np.minimum(n_left[x], n_left[y]))
            hit = (key[x] == key[y]) & (ll + k + rr >= least)
            low[2, x[hit]], high[2, x[hit]] = reach - rr[hit], ll[hit]
            for name, v in (("i", x), ("j", y), ("l", ll), ("r", rr)):
                out[name].append(v[hit])
    return tuple({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in d.items()} for d in (out, edge))


def compare(table: pa.Table, k: int, least: int, reach: int, across: bool) -> dict:
    """Matches of neighbours in a sorted table."""
    key, row = (table[c].to_numpy() for c in ("key", "row"))
    n_right, n_left = (table[c].to_numpy().astype(np.int64) for c in ("n_right", "n_left"))
    right, left = (_matrix(table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c], reach) for c in ("right", "left"))
    n = len(key)
    who = row if across else np.arange(n)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (who[1:] != who[:-1])])
    starts = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    ends = np.concatenate([starts[1:], [n]])
    found = {"i": [], "j": [], "l": [], "r": []}
    for other, ok in ((starts[run] - 1, starts[run] > 0), (ends[run], ends[run] < n)):
        i = np.flatnonzero(ok)
        i = i[key[other[i]] == key[i]]
        for a in range(0, len(i), 50_000):
            x = i[a : a + 50_000]
            y = other[x]
            r = _agree(right[x], right[y], np.minimum(n_right[x], n_right[y]))
            l = _agree(left[x], left[y], np.minimum(n_left[x], n_left[y]))
            hit = l + k + r >= least
            for name, v in (("i", x), ("j", y), ("l", l), ("r", r)):
                found[name].append(v[hit])
    return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, tuple[bool, bool]]]:
    """A sorted part in tables of about PIECE rows, and whether the first and the last
    key of each may go on in another table or part."""
    held: list[pa.RecordBatch] = []
    rows, cut = 0, True  # the part's first key may have begun in the part before
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < PIECE:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = table["key"].to_numpy()
        at = int(np.searchsorted(key, key[-1]))  # where the last key begins
        if at:
            yield table.slice(0, at).combine_chunks(), (cut, False)
            rest, cut = table.slice(at), False
            # A last key that is a whole piece by itself is cut.
            if rest.num_rows >= PIECE:
                yield rest.combine_chunks(), (False, True)
                rest, cut = rest.slice(rest.num_rows), True
        else:
            yield table, (cut, True)
            rest, cut = table.slice(rows), True
        held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks(), (cut, True)


_RESULT = ["id", "row", "start", "end", "other_id", "other_start", "window"]


def _matcher(k: int, least: int, across: bool):
    reach = least - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in _pieces(batches):
            found = compare(table, k, least, reach, across)
            further, windows = compare_windows(table, found, k, least, reach, across, cut)
            i, j, l, r = (np.concatenate([found[c], further[c]]).astype(np.int64) for c in ("i", "j", "l", "r"))
            pos = table["pos"].to_numpy().astype(np.int64)
            ids, rows = table["id"].combine_chunks(), table["row"].combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(i)), rows.take(pa.array(i)), pa.array(pos[i] - l), pa.array(pos[i] + k + r), ids.take(pa.array(j)), pa.array(pos[j] - l), pa.nulls(len(i), pa.int64())], _RESULT)
            # Windows that other pieces may have: no matches yet.
            at, n = windows["i"].astype(np.int64), len(windows["i"])
            start = pos[at] - windows["l"].astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), rows.take(pa.array(at)), pa.array(start), pa.array(start + least), pa.nulls(n, ids.type), pa.nulls(n, pa.int64()), pa.array(windows["window"].astype(np.int64))], _RESULT)

    return run


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, k: int = K, across: bool = True) -> DataFrame:
    """A row for each passage of min_words words or more that occurs elsewhere too:
    id_col, start, end (words, end exclusive), n_words, other_id, other_start.

    Passages of a text that overlap are one row, up to their last word; other_* is
    where the longest match that was compared is found again (of words whose K words
    many texts share, a match is min_words long). across: only matches between
    different rows of df count, else also within a text. Texts that are null, empty
    or shorter have none; equal texts and rows that repeat match whole; a null id
    stays null; an empty table gives no rows. Other columns of df are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    source = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    result = f"id {kind}, row long, start long, `end` long, other_id {kind}, other_start long, window long"
    suffixes = source.mapInArrow(trimmed(_suffixes(k, min_words)), f"key long, right binary, left binary, id {kind}, row long, pos int, n_right smallint, n_left smallint")
    by = ("key", "right", "left", "row", "pos")
    dealt = suffixes.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    found = materialize(dealt.mapInArrow(trimmed(_matcher(k, min_words, across)), result), "matches")
    spans = found.where("window is null").select("id", "row", "start", "end", "other_id", "other_start")
    # Windows of keys that a cut may divide: each is held against the least and the greatest row that has it.
    shared = found.where("window is not null").select("window", "id", "row", "start", "end")
    who = F.col("row") if across else F.struct("row", "start")
    ends = shared.groupBy("window").agg(F.min(F.struct("row", "start", "id")).alias("lo"), F.max(F.struct("row", "start", "id")).alias("hi"), F.min(who).alias("__a"), F.max(who).alias("__b")).where("__a != __b")
    other = F.when((F.col("lo.row") != F.col("row")) if across else (F.struct("row", "start") != F.struct("lo.row", "lo.start")), F.col("lo")).otherwise(F.col("hi"))
    shared = shared.join(ends, "window").withColumn("other", other)
    spans = spans.union(shared.select("id", "row", "start", "end", F.col("other.id"), F.col("other.start")))
    order = Window.partitionBy("row").orderBy("start", F.col("end").desc())
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("fresh", F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)).withColumn("island", F.sum("fresh").over(order))
    longest = F.max(F.struct((F.col("end") - F.col("start")).alias("n"), F.col("other_start"), F.col("other_id"))).alias("longest")
    out = spans.groupBy("row", "island").agg(F.first("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), longest)
    return out.select(F.col("id").alias(id_col), "start", "end", (F.col("end") - F.col("start")).alias("n_words"), F.col("longest.other_id").alias("other_id"), F.col("longest.other_start").alias("other_start"))
