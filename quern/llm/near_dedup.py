"""MinHash near-dedup: DartMinHash signatures, banded.

A document is a set of shingles of five words, each with a weight. A shingle owns a
region, its weight wide; hashed darts fall on the regions with a rank, and of the
darts that name a coordinate the earliest one is its value. Only about k ln k + 2k
darts a document are looked at, however large its set. Two documents agree on a
coordinate with the probability of their (weighted) Jaccard similarity.

Documents with equal shingles are one node. Bands of coordinates are sorted over
the cluster, each band's nodes by the coordinates that follow it, as in an LSH
forest. In a bucket every node is held against the bucket's smallest node and
against its neighbour in the sort: a bucket costs twice its size, never its square.
The similarity of the pairs is then computed from the whole sets; links at least
`threshold` alike stay, and their connected components are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, factorial, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components, merged
from ._shared import materialize, partitions, sized, small_batches, trimmed
from ._words import Words, chunks, mix, ngram_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5  # a pair 0.8 alike meets in a band with a probability of 0.99995
MANY_PAIRS = 200_000  # more pairs than this are first thinned out by central nodes; none is left out
BLOCK = 500  # nodes of a bucket that are held against as many others in one step
FEW_NODES = 500_000  # ids of so many nodes, 4 MB, are broadcast at most
TASK_SETS = 2_000  # rows with whole sets or all their bands in a task, where there are few
_POISSON = np.cumsum([exp(-1) / factorial(i) for i in range(18)])
_U = float(1 << 53)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) / _U


def _darts(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, strip: np.ndarray, first: np.ndarray, count: np.ndarray, k: int):
    """Darts of every (region strip, unit of rank) cell: owner, coordinate, rank, id."""
    at = np.repeat(np.arange(len(owner)), count)
    unit = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + first[at]
    cell = mix(mix(element[at] + strip[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) + unit.astype(np.uint64))
    n = np.searchsorted(_POISSON, _uniform(cell), side="right")
    own = np.repeat(np.arange(len(at)), n)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    dart = mix(cell[own] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x8CB92BA72F3D8DD7))
    place = mix(dart ^ np.uint64(0xA0761D6478BD642F))
    hit = strip[at[own]] + _uniform(place) < weight[at[own]]  # only the last strip of a region is not whole
    own, dart = own[hit], dart[hit]
    return owner[at[own]], (mix(dart + np.uint64(1)) % np.uint64(k)).astype(np.int64), unit[own] + _uniform(dart), dart


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """n rows of k coordinates (ids of darts); a row without elements is zeros.
    owner must be sorted; weights are positive."""
    total = np.bincount(owner, weight, n)
    strips = np.ceil(weight).astype(np.int64)
    pick = np.repeat(np.arange(len(owner)), strips)
    strip = np.arange(len(pick)) - np.repeat(np.cumsum(strips) - strips, strips)
    own, el, w = owner[pick], element[pick], weight[pick]
    enough = k * log(k) + 2 * k if k > 1 else 4.0
    units = np.maximum(1, np.ceil(enough / np.maximum(total, 1e-9))).astype(np.int64)
    units[total == 0] = 0
    best, value = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    first = np.zeros(n, np.int64)
    todo = total > 0
    while todo.any():
        use = todo[own]
        d_owner, d_at, d_rank, d_id = _darts(own[use], el[use], w[use], strip[use], first[own[use]], units[own[use]], k)
        key = d_owner * k + d_at
        before = best.copy()
        np.minimum.at(best, key, d_rank)
        won = (d_rank == best[key]) & (d_rank < before[key])
        value[key[won]] = d_id[won]
        # Coordinates that no dart has named yet: later ranks, for those documents only.
        first += units
        todo &= np.isinf(best.reshape(n, k)).any(1)
        units = np.where(todo, units, 0)
    return value.reshape(n, k)


def shingle_sets(words: Words, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, 32-bit hash and count of every distinct shingle, sorted."""
    h, owner = ngram_hashes(words, n)
    key, count = np.unique((owner.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)), return_counts=True)
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), count


def bands_of(sig: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row and band a hash of the band, and a byte each of the 8 coordinates that follow."""
    n, k = sig.shape
    keys, tails = np.zeros((n, bands), np.uint64), np.zeros((n, bands), np.uint64)
    for b in range(bands):
        h = np.full(n, b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(31) + sig[:, b * rows + r])
        keys[:, b] = h
        for r in range(8):
            tails[:, b] = (tails[:, b] << np.uint64(8)) | (sig[:, (b * rows + rows + r) % k] & np.uint64(0xFF))
    return keys.view(np.int64), tails.view(np.int64)


def _sketcher(bands: int, rows: int, n_words: int, weigh: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in chunks(batches):
            n = len(words)
            owner, element, count = shingle_sets(words, n_words)
            weight = count.astype(np.float64) if weigh == "count" else np.ones(len(count))
            sig = signatures(owner, mix(element.astype(np.uint64) + np.uint64(1)), weight, n, bands * rows)
            keys, tails = bands_of(sig, bands, rows)
            cuts = np.searchsorted(owner, np.arange(n + 1))
            sets = [element[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
            some = np.diff(cuts) > 0
            lists = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(some) * bands]).astype(np.int32), x[some].ravel()) for x in (keys, tails)]
            counts = [count[a:b].astype("<u4").tobytes() if weigh == "count" else b"" for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["row"], pa.array(sets, pa.binary()), pa.array(counts, pa.binary()), *lists], ["id", "row", "shingles", "counts", "keys", "tails"])

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted part: (a, b, near, key). near 0: a node and the bucket's smallest;
    1: neighbours; 2: the smallest node of a bucket that other parts may continue;
    3: a node of a bucket of three or more, or of one that other parts may continue,
    with its agreement with the others as b."""
    parts = [[b[c].to_numpy() for c in ("key", "tail", "node")] for b in batches if b.num_rows]
    if not parts:
        return
    key, tail, node = (np.concatenate(x) for x in zip(*parts))
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    least = np.minimum.reduceat(node, starts)
    lead = np.repeat(least, sizes)
    near = np.flatnonzero((key[1:] == key[:-1]) & (node[1:] != lead[1:]) & (node[:-1] != lead[:-1]))
    far = np.flatnonzero(node != lead)
    edge = np.unique([0, len(starts) - 1])
    more = sizes >= 3
    more[edge] = True
    every = np.flatnonzero(np.repeat(more, sizes))
    bucket, shared = np.repeat(np.arange(len(sizes)), sizes)[every] << 8, np.zeros(len(every), np.int64)
    for r in range(8):
        _, which, n = np.unique(bucket | ((tail[every] >> (8 * r)) & 255), return_inverse=True, return_counts=True)
        shared += n[which]
    a = np.concatenate([lead[far], np.minimum(node[near], node[near + 1]), least[edge], node[every]])
    b = np.concatenate([node[far], np.maximum(node[near], node[near + 1]), least[edge], shared])
    kind = np.repeat([0, 1, 2, 3], [len(far), len(near), len(edge), len(every)]).astype(np.int32)
    keys = np.concatenate([key[far], key[near], key[starts[edge]], key[every]])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, kind, keys)], ["a", "b", "near", "key"])


def candidates(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes (a < b) to be held against each other first, with the least near;
    and (key, node, score) of the buckets in which there are others."""
    spark = sketches.sparkSession
    rows = sketches.select("node", F.posexplode("keys").alias("i", "key"), "tails").select("key", F.expr("tails[i]").alias("tail"), "node")
    by = ("key", "tail", "node")
    found = rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).mapInArrow(trimmed(_pairs), "a long, b long, near int, key long")
    found = materialize(found, "pairs")
    n, n_ends = found.agg(F.count_if(F.col("near") < 2), F.count_if(F.col("near") == 2)).first()
    # Two rows a part at most: the smallest nodes of a bucket that several parts share.
    ends = sized(found.where("near = 2").select("key", "a").distinct(), n_ends)
    least = ends.groupBy("key").agg(F.min("a").alias("m"))
    across = sized(ends.join(least, "key"), n_ends).where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"), F.lit(0).alias("near"))
    every = found.where("near < 2").select("a", "b", "near").union(across)
    pairs = materialize(sized(every.groupBy("a", "b").agg(F.min("near").alias("near")), n + n_ends), "pairs")
    return pairs, found.where("near = 3").select("key", F.col("a").alias("node"), F.col("b").alias("score"))


def jaccard(a: bytes, b: bytes, ca: bytes = b"", cb: bytes = b"") -> float:
    """Similarity of two sorted sets, weighted where counts are given."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    if not ca:
        n = np.count_nonzero(both)
        return n / (len(x) + len(y) - n)
    p, q = np.frombuffer(ca, "<u4").astype(np.int64), np.frombuffer(cb, "<u4").astype(np.int64)
    n = np.minimum(p[both], q[at[both]]).sum()
    return n / (p.sum() + q.sum() - n)


def _verifier(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            cols = [t[c].to_pylist() for c in ("sa", "sb", "ca", "cb")]
            s = np.array([jaccard(*x) for x in zip(*cols)])
            keep = np.flatnonzero(s >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([t["a"].take(pa.array(keep)), t["b"].take(pa.array(keep)), pa.array(s[keep], pa.float64())], ["a", "b", "similarity"])

    return run


def verified(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """The pairs that are alike, by their whole sets. Sets of nodes in no pair don't move."""
    n = pairs.count()
    used = materialize(sized(pairs.select("a").union(pairs.select("b")).distinct(), 2 * n).withColumnRenamed("a", "__used"), "used")
    used = F.broadcast(used) if used.count() <= FEW_NODES else used
    sets = materialize(sketches.join(used, F.col("node") == F.col("__used"), "left_semi").select("node", "shingles", "counts"), "sets")
    out = pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("counts").alias("cb")), "b")
    out = sized(out, n, TASK_SETS).join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("counts").alias("ca")), "a")
    out = sized(out, n, TASK_SETS)
    return materialize(out.mapInArrow(trimmed(_verifier(threshold)), "a long, b long, similarity double"), "links")


def _alike(sets: list[tuple[bytes, bytes]], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, similarity) of all pairs i < j of the sets that are at least `threshold` alike."""
    n = len(sets)
    element = np.concatenate([np.frombuffer(x, "<u4") for x, _ in sets]).astype(np.uint64) << np.uint64(32)
    owner = np.repeat(np.arange(n), [len(x) // 4 for x, _ in sets])
    if any(c for _, c in sets):
        # A shingle that a set has c times counts as c elements.
        count = np.concatenate([np.frombuffer(c, "<u4") for _, c in sets]).astype(np.int64)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        element, owner = np.repeat(element, count) + nth.astype(np.uint64), np.repeat(owner, count)
    size = np.bincount(owner, minlength=n)
    _, which, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[which]
    order = np.argsort(np.where(shared[which], column, -1), kind="stable")[np.count_nonzero(~shared[which]) :]
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float32)
    for c in range(0, int(shared.sum()), 4096):
        x, y = np.searchsorted(column, (c, c + 4096))
        m = np.zeros((n, min(4096, int(shared.sum()) - c)), np.float32)
        m[owner[x:y], column[x:y] - c] = 1
        both += m @ m.T
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        s = both[i, j] / np.maximum(size[i] + size[j] - both[i, j].astype(np.float64), 1)
        hit = s >= threshold - 1e-12
        yield np.full(np.count_nonzero(hit), i), j[hit], s[hit]


def _block_links(threshold: float):
    def links(rows: pa.Table) -> pa.RecordBatch:
        node, root, block = (rows[c].to_numpy() for c in ("node", "root", "block"))
        i, j, s = (np.concatenate(x) for x in zip(*_alike(list(zip(rows["shingles"].to_pylist(), rows["counts"].to_pylist())), threshold)))
        # Pairs within a block are those of the step in which it is held against itself.
        keep = (root[i] != root[j]) & ((block[i] != block[j]) | (block.min() == block.max()))
        i, j, s = i[keep], j[keep], s[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j])), pa.array(s, pa.float64())], ["a", "b", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            step = np.stack([batch[c].to_numpy() for c in ("key", "low", "high")])
            cuts = [0, *(np.flatnonzero((step[:, 1:] != step[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                now = tuple(step[:, x].tolist())
                if now != last and kept:
                    table = pa.Table.from_batches(kept)
                    if table.num_rows > 1:
                        yield links(table)
                    kept = []
                kept.append(batch.slice(x, y - x))
                last = now
        if kept and sum(b.num_rows for b in kept) > 1:
            yield links(pa.Table.from_batches(kept))

    return run


def _several(rows: DataFrame, roots: DataFrame) -> tuple[DataFrame, int]:
    """Rows (key, node, score, root, n) of the buckets of n nodes that are of several
    components, and the number of their pairs of different components."""
    n = rows.count()
    rows = sized(rows.select("key", "node", "score").join(roots.select(F.col("node").alias("__n"), "root"), F.col("node") == F.col("__n"), "left"), n)
    rows = materialize(rows.select("key", "node", "score", F.coalesce("root", "node").alias("root")), "buckets")
    sizes = sized(rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")), n).groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("q"))
    sizes = materialize(sized(sizes, n).where("n * n > q").select(F.col("key").alias("k"), "n", ((F.col("n") * F.col("n") - F.col("q")) / 2).alias("pairs")), "several")
    out = sized(rows.join(sizes.select("k", "n"), F.col("key") == F.col("k")), n).drop("k")
    return materialize(out, "several"), int(sizes.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0])


def completed(buckets: DataFrame, sketches: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """node, root by those of `roots` and by all further links between nodes of a bucket."""
    rows, n = _several(buckets, roots)
    before, led = None, None
    while n > MANY_PAIRS and (before is None or n < 0.75 * before):
        # The node that agrees most with others, over all its buckets; each leads once.
        many = rows.count()
        score = sized(rows.groupBy(F.col("node").alias("lead")).agg(F.sum("score").alias("total")), many)
        score = materialize(score if led is None else sized(score.join(led, "lead", "left_anti"), many), "scores")
        leads = sized(rows.join(score, F.col("node") == F.col("lead")), many).groupBy(F.col("key").alias("k")).agg(F.max(F.struct("total", "lead", "root")).alias("of"))
        leads = materialize(sized(leads, many).select("k", "of.lead", F.col("of.root").alias("lead_root")), "leads")
        pairs = sized(rows.join(leads, F.expr("key = k and root != lead_root")), many).select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        links = verified(materialize(sized(pairs.distinct(), many), "pairs"), sketches, threshold)
        led = leads.select("lead") if led is None else led.union(leads.select("lead"))
        roots, before = merged(roots, links), n
        rows, n = _several(rows, roots)
    if not n:
        return roots
    blocks = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long")).withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    steps = blocks.select("key", "node", "root", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    steps = steps.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.col("node").alias("__n"), "root", "block")
    used = materialize(sized(rows.select(F.col("node").alias("__used")).distinct(), rows.count()), "used")
    used = F.broadcast(used) if used.count() <= FEW_NODES else used
    sets = materialize(sketches.join(used, F.col("node") == F.col("__used"), "left_semi"), "sets")
    by = ("key", "low", "high")
    dealt = steps.join(sets, F.col("__n") == F.col("node")).drop("__n").repartition(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    more = materialize(dealt.mapInArrow(trimmed(_block_links(threshold)), "a long, b long, similarity double"), "links")
    return merged(roots, more)


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weigh: str = "set") -> DataFrame:
    """One row for each row of df: id_col, class_id, class_size, kept.

    class_id is the smallest id of the class, class_size counts its rows; kept marks
    one row of each class, of the smallest id. weigh: "set" compares sets, "count"
    weighs shingles by their counts. A text of fewer words has one shingle of all its
    words; texts without words (null: empty) are one class each by their exact text.
    Rows with a null id take part; a class with no other id has a null class_id. An
    empty table gives no rows. Other columns of df are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    source = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(trimmed(_sketcher_with_text(bands, rows, words, weigh)), f"id {kind}, row long, h1 long, h2 long, shingles binary, counts binary, keys array<long>, tails array<long>")
    all_rows = materialize(out, "sketches")
    n = all_rows.count()
    nodes = materialize(sized(all_rows.groupBy("h1", "h2").agg(F.min("row").alias("node")), n), "nodes")
    # A node is known by the row that stands for it: no hot key.
    one = sized(all_rows.join(nodes.select("node"), F.col("row") == F.col("node"), "left_semi"), n, TASK_SETS)
    pairs, buckets = candidates(one.select(F.col("row").alias("node"), "keys", "tails"))
    sketches = all_rows.select(F.col("row").alias("node"), "shingles", "counts")
    roots = components(verified(pairs.where("near = 0"), sketches, threshold))
    # Neighbours in the sort that those links do not join yet.
    rest, near = pairs.where("near = 1"), pairs.count()
    for side in ("a", "b"):
        rest = sized(rest.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left"), near)
    rest = materialize(rest.where("coalesce(ra, a) != coalesce(rb, b)").select("a", "b"), "rest")
    roots = completed(buckets, sketches, merged(roots, verified(rest, sketches, threshold)), threshold)
    of_node = sized(nodes.join(roots.withColumnRenamed("node", "__node"), F.col("node") == F.col("__node"), "left"), n)
    of_node = materialize(of_node.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.coalesce("root", "node").alias("root")), "classes")
    placed = materialize(sized(all_rows.select("id", "row", "h1", "h2").join(of_node, F.expr("h1 = g1 and h2 = g2")), n).select("id", "row", "root"), "placed")
    classes = placed.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("stays"))
    classes = materialize(sized(classes, n).withColumnRenamed("root", "__root"), "classes")
    joined = sized(placed.join(classes, F.col("root") == F.col("__root")), n)
    return joined.select(F.col("id").alias(id_col), "class_id", "class_size", (F.col("row") == F.col("stays.row")).alias("kept"))


def _sketcher_with_text(bands: int, rows: int, n_words: int, weigh: str):
    """Sketches with 128 bits of each set (of the text, where it has no words)."""
    from hashlib import blake2b

    inner = _sketcher(bands, rows, n_words, weigh)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch["text"], 0
            for out in inner(iter([batch])):
                digests = []
                for i, (s, c) in enumerate(zip(out["shingles"].to_pylist(), out["counts"].to_pylist())):
                    what = s + b"|" + c if s else b"text" + (texts[at + i].as_py() or "").encode()
                    digests.append(blake2b(what, digest_size=16).digest())
                at += out.num_rows
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([out["id"], out["row"], pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), *[out[c] for c in ("shingles", "counts", "keys", "tails")]], ["id", "row", "h1", "h2", "shingles", "counts", "keys", "tails"])

    return run
