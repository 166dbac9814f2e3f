"""What aligned reads show: operations with their reference places, and how often
insertions and deletions come within runs of one letter and outside of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .intervals import coalesce_equal

LETTERS = 200_000  # letters of CIGAR texts that are parsed at once, about


SPOT = 64  # places whose letters are the bits of a number
_LETTER, _MOVES = (np.isin(np.arange(256), [ord(c) for c in x]) for x in ("MIDNSHP=X", "MDN=X"))  # by byte


def _parsed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length and letter (a byte) of each operation of CIGAR texts without nulls."""
    texts = texts.cast(pa.large_string())
    cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    digit, head = (data >= 48) & (data <= 57), np.zeros(len(data), bool)
    head[cuts[:-1][cuts[:-1] < len(data)]] = True
    at = np.flatnonzero(_LETTER[data[1:]] & digit[:-1] & ~head[1:]) + 1
    value, scale, q, more = np.zeros(len(at), np.int64), 1, at - 1, np.ones(len(at), bool)
    while more.any():
        if scale > 10**17:
            raise ValueError("an operation's length has more than 18 digits")
        value += np.where(more, (data[q].astype(np.int64) - 48) * scale, 0)
        more &= ~head[q]
        scale, q = scale * 10, np.maximum(q - 1, 0)
        more &= digit[q]
    return np.searchsorted(cuts, at, side="right") - 1, value, data[at]


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of first, cigar (last) and others, a row for each operation."""
    for batch in batches:
        # Rows whose texts are parsed at once: some ten thousands of letters, or one row.
        ends = np.cumsum(pc.binary_length(batch["cigar"]).to_numpy(zero_copy_only=False))
        steps = np.arange(LETTERS, int(ends[-1]), LETTERS) if len(ends) else []
        cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, steps), [batch.num_rows]])).astype(int).tolist()
        for x, y in zip(cuts, cuts[1:]):
            part = batch.slice(x, y - x)
            row, length, op = _parsed(part["cigar"])
            n = np.bincount(row, minlength=y - x)
            upto = np.concatenate([[0], np.cumsum(np.where(_MOVES[op], length, 0))])
            starts = np.cumsum(n) - n
            at = part["first"].to_numpy()[row] + upto[:-1] - upto[starts][row]
            span = (upto[starts + n] - upto[starts])[row]
            own = part.drop_columns(["cigar"]).take(pa.array(row))
            letter = pa.DictionaryArray.from_arrays(pa.array(op.astype(np.int16)), pa.array([chr(i) for i in range(128)])).cast(pa.string())
            columns = [*own.columns, pa.array((np.arange(len(row)) - starts[row]).astype(np.int32)), letter, pa.array(length), pa.array(at), pa.array(span)]
            yield pa.RecordBatch.from_arrays(columns, [*own.schema.names, "i", "op", "length", "at", "span"])


def operations(reads: DataFrame, key: Sequence[str], cigar: str = "cigar", pos: str = "pos") -> DataFrame:
    """Each operation of each read's CIGAR text: key, contig, first (the read's place), i
    (from 0), op, length, at (the reference place where it begins, from 0) and span (the
    reference letters of the whole read).

    Places are sums of the lengths of M, D, N, = and X before it, made row by row: reads
    don't move, and key may be any columns. A read without a CIGAR text (null, *, empty),
    contig or place has no rows."""
    d = reads.where(F.col("contig").isNotNull() & F.col(pos).isNotNull() & F.col(cigar).isNotNull())
    d = d.select(*key, "contig", F.col(pos).cast("long").alias("first"), F.col(cigar).alias("cigar"))
    kind = T.StructType([*d.schema.fields[:-1], *[T.StructField(c, t) for c, t in (("i", T.IntegerType()), ("op", T.StringType()), ("length", T.LongType()), ("at", T.LongType()), ("span", T.LongType()))]])
    return d.mapInArrow(_placed, kind)


def letter_runs(blocks: DataFrame, width: int, least: int) -> DataFrame:
    """contig, letter, start, end of the runs of at least `least` (2 or more) equal letters
    A, C, G or T, in either case. blocks: contig, block, seq, `width` letters each but the last.

    A block gives its own long runs and those that touch its borders, however short; runs
    that go on in the next block are then joined. Blocks without letters have none."""
    s = F.upper("seq")
    pattern = F.lit(r"(.*?)(([ACGT])\3{%d,})" % (least - 1))
    gaps, runs = F.regexp_extract_all(s, pattern, F.lit(1)), F.regexp_extract_all(s, pattern, F.lit(2))
    kind = "array<struct<letter:string,at:bigint,n:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, x: Column) -> Column:
        at, n = a["at"] + F.length(x["gap"]), F.length(x["run"]).cast("long")
        return F.struct((at + n).alias("at"), F.concat(a["out"], F.array(F.struct(F.substring(x["run"], 1, 1).alias("letter"), at.alias("at"), n.alias("n")))).alias("out"))

    inner = F.aggregate(F.zip_with(gaps, runs, lambda g, r: F.struct(g.alias("gap"), r.alias("run"))), start, step, lambda a: a["out"])
    head = F.regexp_extract(s, r"^(([ACGT])\2*)", 1)
    last = F.right(s, F.lit(1))
    tail = F.length(s) - F.length(F.rtrim(s, last))
    ends = F.array(
        F.struct(F.substring(s, 1, 1).alias("letter"), F.lit(0).cast("long").alias("at"), F.length(head).cast("long").alias("n")),
        F.struct(last.alias("letter"), (F.length(s) - tail).cast("long").alias("at"), tail.cast("long").alias("n")))
    pieces = blocks.select("contig", "block", F.explode(F.array_distinct(F.concat(inner, ends))).alias("r")).where(F.col("r.n") > 0).where(F.col("r.letter").isin(*"ACGT"))
    pieces = pieces.select("contig", F.col("r.letter").alias("letter"), (F.col("block") * width + F.col("r.at")).alias("start"), (F.col("block") * width + F.col("r.at") + F.col("r.n")).alias("end"))
    return coalesce_equal(pieces, ["contig"], ["letter"]).where(F.col("end") - F.col("start") >= least).select("contig", "letter", "start", "end")


def _in_spots(d: DataFrame) -> DataFrame:
    """Rows with start and end in each spot that they touch, with the bits of their places in
    it; an empty one is in the spot of its start, without bits."""
    first = F.floor(F.col("start") / SPOT)
    d = d.withColumn("spot", F.explode(F.sequence(first, F.greatest(first, F.floor((F.col("end") - 1) / SPOT)))))
    d = d.withColumn("__low", F.greatest(F.col("start") - F.col("spot") * SPOT, F.lit(0)).cast("int")).withColumn("__high", F.least(F.col("end") - F.col("spot") * SPOT, F.lit(SPOT)).cast("int"))
    bits = F.expr(f"if(__high > __low, shiftleft(shiftrightunsigned(-1L, {SPOT} - __high + __low), __low), 0L)")
    return d.withColumn("bits", bits).drop("__low", "__high", "start", "end")


def _with_bits(d: DataFrame, spans: DataFrame, at: str, name: str) -> DataFrame:
    """d with the bits of spans (contig, start, end) in the spot `at` as name; null where none is."""
    s = _in_spots(spans.where(F.col("end") > F.col("start"))).groupBy(F.col("contig").alias("__on"), F.col("spot").alias("__spot")).agg(F.bit_or("bits").alias(name))
    # A number a spot is held in tables; the operations are many and need no sort.
    return d.join(s.hint("shuffle_hash"), (F.col("contig") == F.col("__on")) & (F.col(at) == F.col("__spot")), "left").drop("__on", "__spot")


def indels_in_runs(reads: DataFrame, key: Sequence[str], blocks: DataFrame, width: int, by: Sequence[str] = (), least: int = 6, known: DataFrame | None = None, pad: int = 10, least_span: int = 0) -> DataFrame:
    """by, context (run, other): aligned, insertions, deletions, inserted, deleted, events
    and bases a million aligned letters, and enrichment (the run's event rate over the other's).

    reads: key (one row each), by, contig, pos (from 0), cigar, of primary alignments; those
    that span less than `least_span` reference letters are left out. Aligned letters (M, =,
    X) count where they stand; a deletion where it begins, an insertion at the letter before
    it (the read's first one, if it comes first). Those within `pad` of a known one (contig,
    pos: the letter before it, from 0) are left out of events and counted as excluded.
    Letters of runs of at least `least` are in context run, wherever the read begins. A rate
    without aligned letters is null, and an enrichment without events in the other context.
    Reads without a place have no part in it. Letters are bits of spots of 64 places: an
    operation is in the few spots that it touches, runs are a number a spot, and no two
    of them meet as spans do."""
    keep = list(dict.fromkeys(by))
    ops = operations(reads.select(*keep, "contig", "pos", "cigar"), keep).where(F.col("op").isin("M", "=", "X", "I", "D"))
    ops = ops.where(F.col("span") >= least_span) if least_span > 0 else ops
    length, indel = F.col("length"), F.col("op").isin("I", "D")
    site = F.when(F.col("op") == "D", F.col("at")).otherwise(F.greatest(F.col("at") - 1, F.col("first")))
    d = ops.withColumn("start", F.when(indel, site).otherwise(F.col("at"))).withColumn("end", F.when(indel, site + 1).otherwise(F.col("at") + length))
    d = _in_spots(d)
    runs = letter_runs(blocks, width, least).select("contig", "start", "end")
    d = _with_bits(d, runs, "spot", "__runs")
    if known is not None:
        near = known.where("pos is not null").select("contig", (F.col("pos") - pad).alias("start"), (F.col("pos") + pad + 1).alias("end"))
        d = _with_bits(d.withColumn("__edge", F.floor(F.col("at") / SPOT)), near, "__edge", "__near")
        old = F.expr(f"shiftright(coalesce(__near, 0L), cast(pmod(at, {SPOT}) as int)) & 1 = 1")
    else:
        old = F.lit(False)
    both = F.coalesce(F.col("bits").bitwiseAND(F.col("__runs")), F.lit(0).cast("long"))
    letters, inner, in_run = F.bit_count("bits").cast("long"), F.bit_count(both).cast("long"), both != 0
    sums = {}
    for context, here in (("run", in_run), ("other", ~in_run)):
        for name, when, v in (("insertions", F.col("op") == "I", F.lit(1)), ("deletions", F.col("op") == "D", F.lit(1)), ("inserted", F.col("op") == "I", length), ("deleted", F.col("op") == "D", length)):
            sums[f"{context}_{name}"] = F.sum(F.when(indel & here & when & ~old, v).otherwise(0))
        sums[f"{context}_excluded"] = F.count_if(indel & here & old)
        sums[f"{context}_indels"] = F.count_if(indel & here)
    sums["run_aligned"], sums["other_aligned"] = F.sum(F.when(~indel, inner).otherwise(0)), F.sum(F.when(~indel, letters - inner).otherwise(0))
    sums["run_any"], sums["other_any"] = F.count_if(~indel & in_run), F.count_if(~indel)
    d = d.groupBy(*by).agg(*[v.cast("long").alias(c) for c, v in sums.items()])
    names = ("aligned", "insertions", "deletions", "inserted", "deleted", "excluded")
    rows = F.array(*[F.struct(F.lit(c).alias("context"), *[F.col(f"{c}_{n}").alias(n) for n in names], (F.col(f"{c}_any") + F.col(f"{c}_indels")).alias("any")) for c in ("run", "other")])
    out = d.select(*by, F.explode(rows).alias("x")).where("x.any > 0").select(*by, "x.context", *[f"x.{n}" for n in names])
    out = out.withColumn("event_rate", F.try_divide((F.col("insertions") + F.col("deletions")) * 1e6, F.col("aligned"))).withColumn("base_rate", F.try_divide((F.col("inserted") + F.col("deleted")) * 1e6, F.col("aligned")))
    both = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # two rows each
    rate = lambda c: F.max(F.when(F.col("context") == c, F.col("event_rate"))).over(both)
    return out.withColumn("enrichment", F.try_divide(rate("run"), rate("other")))
