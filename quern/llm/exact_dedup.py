"""Exact dedup: two Bloom passes, then only possibly repeated rows shuffle.

Every text is read once, for a 32-byte digest, and the digests are written to the
shared folder. Pass one counts the Bloom slots of the digests, with partial sums
before the shuffle, and keeps one bit for each slot that two rows or more hit.
Pass two tests each row's slots against these bits, which are broadcast and never
larger than MAX_BITS. Rows that fail are unique and pass straight through; the
others shuffle, as digest and id only, and are grouped by the whole digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialize

MAX_BITS = 1 << 30  # 128 MB in 4 kB blocks, the most that is broadcast
MIN_BITS = 1 << 17
BITS_A_ROW = 16
HASHES = 2
BLOCK_BITS = 32768


def filter_bits(rows: int) -> int:
    """Bits of the filter for so many rows: a power of two. Beyond MAX_BITS the
    filter lets more unique rows through to the grouping; results stay the same."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (max(1, rows) * BITS_A_ROW - 1).bit_length()))


def _slots(digest: Column, bits: int) -> list[Column]:
    """One slot in each of HASHES equal parts of the filter."""
    part = bits // HASHES
    return [F.pmod(F.xxhash64(F.lit(k), digest), F.lit(part)) + F.lit(k * part) for k in range(HASHES)]


def repeated_slots(digests: DataFrame, bits: int, digest: str = "digest") -> DataFrame:
    """block, bitmap: 4 kB blocks with a bit for every slot of two rows or more."""
    return (
        digests.select(F.explode(F.array(*_slots(F.col(digest), bits))).alias("slot"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy(F.expr(f"slot div {BLOCK_BITS}").alias("block"))
        .agg(F.bitmap_construct_agg(F.expr(f"slot % {BLOCK_BITS}")).alias("bitmap"))
    )


def possibly_repeated(digests: DataFrame, blocks: DataFrame, bits: int, digest: str = "digest") -> DataFrame:
    """digests with a column __maybe: whether all slots of the row are in blocks."""
    out = digests.withColumn("__maybe", F.lit(True))
    for k, slot in enumerate(_slots(F.col(digest), bits)):
        named = F.broadcast(blocks.select(F.col("block").alias(f"__block{k}"), F.col("bitmap").alias(f"__bits{k}")))
        out = out.withColumn("__slot", slot).join(named, F.expr(f"__slot div {BLOCK_BITS} = __block{k}"), "left")
        byte = f"cast(conv(hex(substring(__bits{k}, cast((__slot % {BLOCK_BITS}) div 8 as int) + 1, 1)), 16, 10) as bigint)"
        hit = F.expr(f"coalesce(bit_get({byte}, cast(__slot % 8 as int)) = 1, false)")
        out = out.withColumn("__maybe", F.col("__maybe") & hit).drop("__slot", f"__block{k}", f"__bits{k}")
    return out


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """One row for each row of df, dropped ones too: id_col, keep_id, group_size,
    kept, text_sha256.

    Texts are equal when identical after normalise (a function of a Column; none:
    no change). Of equal texts the row with the largest id stays; of rows that also
    share the id, one. A null text counts as empty; a null id is smaller than any
    other and is kept only where its group has no other. An empty table gives no
    rows. Other columns of df, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    digests = materialize(df.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    bits = filter_bits(digests.count())
    blocks = materialize(repeated_slots(digests, bits), "bloom")
    tested = possibly_repeated(digests, blocks, bits)
    maybe = tested.where("__maybe")
    # Written out, so that both sides of the join below are exchanges and a hot digest is split.
    groups = materialize(maybe.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("n")), "groups")
    back = maybe.join(groups, "digest")
    alone = tested.where("not __maybe").select(F.col("id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept"), "digest")
    both = alone.unionByName(back.select("id", F.col("keep.id").alias("keep_id"), "n", (F.col("row") == F.col("keep.row")).alias("kept"), "digest"))
    return both.select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))
