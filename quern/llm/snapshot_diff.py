"""The difference of two snapshots of a table, keys that changed included.

Keys are dealt by hash into parts of about KEYS_A_PART keys. For each part an
invertible Bloom lookup table holds, cell by cell, the later rows less the earlier
ones: every row's key and digest go into three cells, as a count and as exclusive-or
sums, so what both snapshots have cancels out. Cells are sums of Spark's own, taken
before the shuffle; a part's cells then meet in one task, which peels them: a cell of
one entry gives that entry, which is taken out of its other cells, and so on. Tables
are sized by the difference of a fixed share of entries; a part that can't be peeled
gets a table twice as large, then its rows are counted entry by entry. The entries
found are verified against the rows: what is left beside them must be the same on both
sides by other sums, else the part is counted too.

Rows of the difference with equal keys pair; those left pair by content, the first
earlier key with the last later one, by ranks that are taken over ranges of (content,
key), so a content that very many rows share is dealt over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize, partitions

KEYS_A_PART = 1024
SAMPLED = 64  # one entry in so many is counted to size the tables
LEAST_CELLS = 48
ROUNDS = 4
HASHES = 3
_ENTRY = ("k", "d0", "d1")
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _xxhash64(seed: int, *columns: np.ndarray) -> np.ndarray:
    """As F.xxhash64(lit(seed), columns) of longs: each one hashed with the hash so far as seed."""
    h = np.full(len(columns[0]), 42, np.uint64)
    for c in (np.full(len(columns[0]), seed, np.int64), *columns):
        x = c.view(np.uint64) * _P2
        x = ((x << np.uint64(31)) | (x >> np.uint64(33))) * _P1
        h = (h + _P5 + np.uint64(8)) ^ x
        h = ((h << np.uint64(27)) | (h >> np.uint64(37))) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _hashed(seed: int) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), *_ENTRY)


def _places(cells: int, turn: int) -> list[Column]:
    """An entry's cells, one in each third of the table."""
    third = cells // HASHES
    return [F.pmod(_hashed(8 * turn + j), F.lit(third)) + F.lit(j * third) for j in range(HASHES)]


def cell_table(rows: DataFrame, cells: int, turn: int) -> DataFrame:
    """part, cell, n, k, d0, d1, check of all cells that aren't empty."""
    spread = rows.select("part", "sign", *_ENTRY, _hashed(-1).alias("check"), F.explode(F.array(*_places(cells, turn))).alias("cell"))
    return spread.groupBy("part", "cell").agg(F.sum("sign").alias("n"), *[F.bit_xor(c).alias(c) for c in (*_ENTRY, "check")]).where("n <> 0 or k <> 0 or d0 <> 0 or d1 <> 0 or check <> 0")


def peeled(cells: int, turn: int, at: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Entries (rows of k, d0, d1) of one part's table, their signs, and whether the
    table came out empty. at: cells that aren't empty; sums: k, d0, d1, check of each."""
    count, total = np.zeros(cells, np.int64), np.zeros((4, cells), np.int64)
    count[at], total[:, at] = n, sums
    found, signs, third = [], [], cells // HASHES
    while True:
        one = np.flatnonzero(np.abs(count) == 1)
        one = one[total[3, one] == _xxhash64(-1, *total[:3, one])]
        if not len(one):
            break
        _, first = np.unique(total[3, one], return_index=True)  # an entry may stand alone in several cells
        one = one[first]
        entry, sign = total[:, one], count[one]
        for j in range(HASHES):
            place = _xxhash64(8 * turn + j, *entry[:3]) % third + j * third
            np.subtract.at(count, place, sign)
            for part, value in zip(total, entry):
                np.bitwise_xor.at(part, place, value)
        found.append(entry[:3])
        signs.append(sign)
        if sum(map(len, signs)) > cells:
            break  # it goes round in circles
    entries = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return entries, np.concatenate(signs) if signs else np.zeros(0, np.int64), not (count.any() or total.any())


def _peel(cells: int, turn: int):
    """Applied to a part's cells: its entries, or one row without an entry if the table can't be peeled."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_numpy() for c in ("part", "cell", "n", *_ENTRY, "check")}
        entries, signs, whole = peeled(cells, turn, columns["cell"], columns["n"], np.stack([columns[c] for c in (*_ENTRY, "check")]))
        part = columns["part"][:1]
        if not whole:
            return pa.table({"part": pa.array(part), **{c: pa.array([None], pa.int64()) for c in ("n", *_ENTRY)}})
        return pa.table({"part": pa.array(np.repeat(part, len(signs))), "n": pa.array(signs), **{c: pa.array(e) for c, e in zip(_ENTRY, entries)}})

    return run


def _counted(rows: DataFrame) -> DataFrame:
    """The difference of rows, entry by entry, however often an entry repeats."""
    return rows.groupBy("part", *_ENTRY).agg(F.sum("sign").alias("n")).where("n <> 0").select("part", "n", *_ENTRY)


def _only(rows: DataFrame, parts: DataFrame) -> DataFrame:
    return rows.join(parts.select("part").distinct(), "part", "left_semi")


def difference(rows: DataFrame, keys: int) -> DataFrame:
    """part, n, k, d0, d1: entries that later rows (sign 1) have more (n > 0) or less
    often than earlier ones (sign -1). rows: part, sign and the entry, written; keys:
    keys a part has at most, about."""
    sample = rows.where(F.pmod(_hashed(-2), F.lit(SAMPLED)) == 0)
    differing = _counted(sample).count() / max(1, sample.count())
    cells = max(LEAST_CELLS, int(2 * keys * differing * 1.5)) // HASHES * HASHES
    left, found = rows, []
    for turn in range(ROUNDS):
        tried = cell_table(left, cells, turn).groupBy("part").applyInArrow(_peel(cells, turn), "part long, n long, k long, d0 long, d1 long")
        tried = materialize(tried, "iblt")
        found.append(tried.where("n is not null"))
        failed = tried.where("n is null").select("part")
        if failed.isEmpty():
            break
        left, cells = _only(rows, failed), 2 * cells
    else:
        found.append(_counted(left))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialize(out, "difference")


def _marked(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """rows with n, how much more often later rows have their entry; null: as often."""
    return rows.join(entries.select(*_ENTRY, "n"), list(_ENTRY), "left")


def _unequal(marked: DataFrame, entries: DataFrame) -> DataFrame:
    """Parts in which the entries don't account for all that differs: of the rows
    without an entry as many, with equal sums of another hash, must be on both sides,
    and the rows with one must differ by the entries."""
    weight = F.shiftrightunsigned(_hashed(-3), 24)
    have = marked.select("part", F.col("n").isNull().alias("same"), F.col("sign").alias("n"), (F.col("sign") * weight).alias("w"))
    told = entries.select("part", F.lit(False).alias("same"), (-F.col("n")).alias("n"), (-F.col("n") * weight).alias("w"))
    sums = have.unionByName(told).groupBy("part", "same").agg(F.sum("n").alias("n"), F.sum(F.col("w").cast("decimal(38,0)")).alias("w"))
    return sums.where("n <> 0 or w <> 0").select("part").distinct()


def ranked(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """rows with rank, from 0 within each group (columns without nulls) by order. Rows
    are dealt by ranges of (group, order) and written; ranks are taken within a range
    and a group's go on from one range to the next, so no group meets in one task."""
    by = [F.col(g) for g in group] + order
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    placed = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()), "ranked")
    counts = placed.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*group, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return placed.join(starts, [*group, "__part"]).withColumn("rank", F.col("__id") + F.col("__shift")).drop("__id", "__part", "__shift")


def _rows(df: DataFrame, key_col: str, content: list[str], others: list[str], sign: int, keep: Column | None) -> DataFrame:
    """sign, key, entry (k, d0, d1: key, null as 0, and 128 bits of a digest of the row),
    content (a digest), h0, h1, ... (a digest of each compared column; null: null) and kept."""
    named = df.select(F.col(key_col).cast("long").alias("key"), *[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate((*content, *others))], (F.lit(None).cast("string") if keep is None else keep).alias("kept"))
    hashed = named.select("key", "kept", *[F.unhex(F.sha2(f"v{i}", 256)).alias(f"h{i}") for i in range(len(content) + len(others))])
    digest = lambda columns: F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.lit(b"\1"), c), F.lit(b"\0")) for c in columns]), 256))
    whole = hashed.withColumn("content", digest([F.col(f"h{i}") for i in range(len(content))])).withColumn("row", digest([F.col("key").cast("string").cast("binary"), *[F.col(f"h{i}") for i in range(len(content) + len(others))]]))
    half = lambda at: F.conv(F.hex(F.substring("row", at, 8)), 16, -10).cast("long")
    return whole.select(F.lit(sign).cast("long").alias("sign"), "key", F.coalesce("key", F.lit(0)).alias("k"), half(1).alias("d0"), half(9).alias("d1"), "content", *[f"h{i}" for i in range(len(content) + len(others))], "kept")


def snapshot_diff(earlier: DataFrame, later: DataFrame, key_col: str = "doc_id", content: tuple[str, ...] = ("text", "lang"), others: tuple[str, ...] = ("source",), keep: Column | None = None) -> DataFrame:
    """A row for each pair, and each row that pairs with none, of two snapshots: key
    (the later one, else the earlier), old_key (the earlier one, null without), op,
    changed (a pair's differing columns, of content and others in this order,
    comma-joined) and kept (keep, an expression of the later row; null without).

    Rows of equal keys (integers; null equals null only) pair: op is same, or update
    where a column of content or others differs. Then, of the rows left, those of equal
    content pair as rekey: the i-th smallest earlier key with the i-th largest later one
    (null is the smallest). The rest is insert and delete. Where a key repeats in a
    snapshot, rows that are equal in all columns pair first, then the others by their
    digests, and the rest by content. Columns are compared as text by sha256 of whole
    values, however long; null equals null only. Empty tables give inserts or deletes
    only, or no rows. Other columns, whatever their names, are not read.
    """
    columns = [*content, *others]
    both = _rows(earlier, key_col, list(content), list(others), -1, None).unionByName(_rows(later, key_col, list(content), list(others), 1, keep))
    written = materialize(both, "snapshots")
    sizes = {r.sign: r.n for r in written.groupBy("sign").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(1, -(-max(sizes.values(), default=0) // KEYS_A_PART))
    rows = written.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(parts)))
    entries = difference(rows.select("part", "sign", *_ENTRY), KEYS_A_PART)
    marked = materialize(_marked(rows, entries), "marked")
    bad = materialize(_unequal(marked, entries), "unequal")
    if not bad.isEmpty():
        again = _only(rows, bad)
        entries = materialize(entries.join(bad, "part", "left_anti").unionByName(_counted(again.select("part", "sign", *_ENTRY))), "difference")
        marked = materialize(_marked(rows, entries), "marked")
    # Of equal rows that both sides have, as many pair as the smaller side has.
    shared = marked.where("n is not null").groupBy(*_ENTRY).agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs("n")).alias("n")).where("rows <> n")
    differing = marked.where("n is not null")
    same = marked.where("n is null and sign = 1")
    if not shared.isEmpty():
        placed = materialize(ranked(differing, [*_ENTRY, "sign"], [F.col("content")]), "repeats")
        extra = (F.col("sign") * F.col("n") > 0) & (F.col("rank") < F.abs("n"))
        same = same.unionByName(placed.where(~extra & (F.col("sign") == 1)).drop("rank"))
        differing = placed.where(extra).drop("rank")
    out = same.select("key", F.col("key").alias("old_key"), F.lit("same").alias("op"), F.lit("").alias("changed"), "kept")

    def sides(of: DataFrame, on: list[str]) -> DataFrame:
        """Earlier and later rows of of with equal columns on (no nulls), side by side."""
        sides = [of.where(f"sign = {s}").select(*on, F.struct("key", "nokey", "k", "d0", "d1", "content", *[f"h{i}" for i in range(len(columns))], "kept").alias(side)) for s, side in ((-1, "a"), (1, "b"))]
        return sides[0].join(sides[1], on, "full_outer")

    def changes() -> Column:
        differ = [F.when(~F.col(f"a.h{i}").eqNullSafe(F.col(f"b.h{i}")), F.lit(c)) for i, c in enumerate(columns)]
        return F.concat_ws(",", *differ)

    keyed = ranked(differing.withColumn("nokey", F.col("key").isNull()), ["k", "nokey", "sign"], [F.col("d0"), F.col("d1")])
    paired = materialize(sides(keyed, ["k", "nokey", "rank"]).select("a", "b"), "keyed")
    updates = paired.where("a is not null and b is not null").select(F.col("b.key").alias("key"), F.col("a.key").alias("old_key"), F.when(changes() == "", "same").otherwise("update").alias("op"), changes().alias("changed"), F.col("b.kept").alias("kept"))
    alone = [paired.where(f"{other} is null").select(F.lit(s).cast("long").alias("sign"), f"{side}.*") for s, side, other in ((-1, "a", "b"), (1, "b", "a"))]
    left = alone[0].unionByName(alone[1])
    # Earlier keys ascend and later ones descend; ~key turns the order of longs without overflow.
    up = F.when(F.col("sign") == -1, F.col("k")).otherwise(F.bitwise_not("k"))
    nulls = F.when(F.col("sign") == -1, ~F.col("nokey")).otherwise(F.col("nokey"))
    matched = materialize(sides(ranked(left, ["content", "sign"], [nulls.asc(), up.asc()]), ["content", "rank"]).select("a", "b"), "matched")
    op = F.when(F.col("a").isNull(), "insert").when(F.col("b").isNull(), "delete").otherwise("rekey")
    rest = matched.select(F.when(F.col("b").isNull(), F.col("a.key")).otherwise(F.col("b.key")).alias("key"), F.col("a.key").alias("old_key"), op.alias("op"), F.when(op == "rekey", changes()).otherwise("").alias("changed"), F.col("b.kept").alias("kept"))
    return out.unionByName(updates).unionByName(rest)
