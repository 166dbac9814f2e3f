"""Interval operators: joins by bins, gaps and islands, tiling.

Intervals are half-open unless a column's name says otherwise. Positions are long
columns (times: microseconds or seconds as long). Null starts or ends match nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 1 << 20  # places whose rows may meet in one task


SPREAD = 8  # bins of a span's level that it touches, about, at most; a level's bins are as many times as wide as those below


def _top(longest: int | None, width: int) -> int | None:
    """The level of the longest span, if that is told."""
    return None if longest is None else max(0, math.ceil(math.log(max(1, longest) / (width * SPREAD), SPREAD)))


def level(start: Column, end: Column, width: int, longest: int | None = None) -> Column:
    """The level of [start, end): bins of width * SPREAD ** level are the finest of which it
    touches at most SPREAD + 1; none higher than that of a span of `longest` places. An
    empty or null interval has none."""
    size = (end - start) / F.lit(float(width * SPREAD))
    found = F.greatest(F.lit(0), F.ceil(F.log2(size) / math.log2(SPREAD)))
    top = _top(longest, width)
    return F.when(end > start, F.lit(0) if top == 0 else found if top is None else F.least(F.lit(top), found)).cast("int")


def bin_of(pos: Column, level: Column, width: int) -> Column:
    return F.floor(pos / (F.lit(float(width)) * F.pow(F.lit(float(SPREAD)), level)))


def bins(start: Column, end: Column, level: Column, width: int) -> Column:
    """The level's bins that [start, end) touches; an empty interval touches none."""
    return F.when(end > start, F.sequence(bin_of(start, level, width), bin_of(end - 1, level, width)))


def _levels(spans: DataFrame, start: str, end: str, width: int, longest: int | None) -> Column:
    """The levels that spans has, as an array: up to that of the longest, if that is told,
    else a few numbers worked out once before the join."""
    if longest is not None:
        return F.array(*[F.lit(i) for i in range(_top(longest, width) + 1)])
    return spans.select(level(F.col(start), F.col(end), width).alias("l")).agg(F.sort_array(F.collect_set("l"))).scalar()


def point_join(points: DataFrame, spans: DataFrame, by: Sequence[str], pos: str = "pos", start: str = "start", end: str = "end", width: int = 1000, how: str = "inner", longest: int | None = None) -> DataFrame:
    """Points with the spans that contain them, start <= pos < end, equal in `by`.

    An equi-join on (by, level, bin) with the exact test as residual: never a nested loop.
    A span is in the few bins of its own level, a point in one bin of each level that spans
    have; so neither a long span nor many short ones make many rows. how: inner, left_semi
    or left_anti (of points; points that repeat stay). longest, if spans are known to have
    at most so many places, saves looking at them first; a longer one is found all the same.
    Columns other than `by` must differ. Null keys, places, starts and ends match nothing; empty spans neither."""
    s = spans.select(*[F.col(c).alias(f"__{c}") if c in by else F.col(c) for c in spans.columns]).withColumn("__slevel", level(F.col(start), F.col(end), width, longest))
    s = s.withColumn("__sbin", F.explode(bins(F.col(start), F.col(end), F.col("__slevel"), width)))
    cond = (F.col("__level") == F.col("__slevel")) & (F.col("__bin") == F.col("__sbin")) & (F.col(pos) >= F.col(start)) & (F.col(pos) < F.col(end))
    for c in by:
        cond = cond & (F.col(c) == F.col(f"__{c}"))
    if _top(longest, width) == 0:  # one bin a point
        return points.withColumn("__level", F.lit(0)).withColumn("__bin", bin_of(F.col(pos), F.lit(0), width)).join(s, cond, how).drop("__level", "__bin", "__slevel", "__sbin", *[f"__{c}" for c in by])
    here = points if how == "inner" else _one_by_one(points)
    here = here.withColumn("__levels", _levels(spans, start, end, width, longest)).withColumn("__level", F.explode_outer("__levels")).drop("__levels")
    here = here.withColumn("__bin", bin_of(F.col(pos), F.col("__level"), width))
    if how == "inner":
        return here.join(s, cond).drop("__level", "__bin", "__slevel", "__sbin", *[f"__{c}" for c in by])
    return _hit_or_not(here, s, cond, points.columns, how)


def _one_by_one(df: DataFrame) -> DataFrame:
    return df.withColumn("__one", F.monotonically_increasing_id())


def _hit_or_not(here: DataFrame, there: DataFrame, cond: Column, columns: Sequence[str], how: str) -> DataFrame:
    """columns of the rows of _one_by_one, each in several rows of here, that meet (left_anti:
    don't meet) a row of there. Numbers given to rows are used once, in one plan: made anew
    they would not be the same ones."""
    met = here.join(there.withColumn("__met", F.lit(True)), cond, "left").groupBy("__one").agg(F.any_value(F.struct(*columns)).alias("__row"), F.max("__met").alias("__met"))
    return met.where(F.col("__met").isNotNull() if how == "left_semi" else F.col("__met").isNull()).select("__row.*")


def _overlapping(a: DataFrame, b: DataFrame, by: Sequence[str], width: int, prefix: str, longest: int | None) -> tuple[DataFrame, DataFrame, Column]:
    """a and b (columns prefixed) in the bins of their own level and of each higher one that
    a side has, and the condition under which two rows are an overlapping pair, once."""
    y = b.select(*[F.col(c).alias(prefix + c) for c in b.columns])
    both = a.select("start", "end").unionByName(b.select("start", "end"))

    def placed(d: DataFrame, pre: str, tag: str) -> DataFrame:
        s, e = F.col(f"{pre}start"), F.col(f"{pre}end")
        d = d.withColumn(f"__own{tag}", level(s, e, width, longest)).withColumn("__levels", _levels(both, "start", "end", width, longest))
        own = F.col(f"__own{tag}")
        d = d.withColumn(f"__level{tag}", F.explode_outer(F.filter("__levels", lambda x: x >= own))).drop("__levels")
        return d.withColumn(f"__bin{tag}", F.explode_outer(bins(s, e, F.col(f"__level{tag}"), width)))

    at = F.col("__level1")
    cond = (at == F.col("__level2")) & (F.col("__bin1") == F.col("__bin2")) & (at == F.greatest("__own1", "__own2"))
    for c in by:
        cond = cond & (F.col(c) == F.col(prefix + c))
    cond = cond & (F.col("end") > F.col(f"{prefix}start")) & (F.col("start") < F.col(f"{prefix}end"))
    cond = cond & (F.col("__bin1") == bin_of(F.greatest(F.col("start"), F.col(f"{prefix}start")), at, width))
    return placed(a, "", "1"), placed(y, prefix, "2"), cond


def overlap_join(a: DataFrame, b: DataFrame, by: Sequence[str], width: int = 1000, prefix: str = "b_", longest: int | None = None) -> DataFrame:
    """Pairs of spans of a and b (columns by, start, end, others) with end > other's
    start and start < other's end, equal in `by`. b's columns get a prefix.

    A pair is emitted at the higher of its levels, in the bin of the later start, so no pair
    repeats. longest as in point_join, of both sides. Empty spans and null keys, starts and
    ends match nothing."""
    x, z, cond = _overlapping(a, b, by, width, prefix, longest)
    return x.join(z, cond).drop("__bin1", "__bin2", "__level1", "__level2", "__own1", "__own2")


def overlap_semi(a: DataFrame, b: DataFrame, by: Sequence[str], width: int = 1000, anti: bool = False, longest: int | None = None) -> DataFrame:
    """Spans of a that overlap any (anti: no) span of b, each once; those that repeat stay.
    Empty spans and null keys, starts and ends overlap none."""
    x, z, cond = _overlapping(_one_by_one(a), b.select(*by, "start", "end"), by, width, "b_", longest)
    return _hit_or_not(x, z, cond, a.columns, "left_anti" if anti else "left_semi")


def _bordered(d: DataFrame, by: Sequence[str], before: dict[str, tuple[Column, str]] = {}, after: dict[str, tuple[Column, str]] = {}) -> DataFrame:
    """d, which has a column __bin that never falls as the order rises, with a row at the
    head (tail) of each bin that stands for its group's bins before (after) it.

    A window over (by, __bin) in order of __side (-1 head, 0 rows, 1 tail) then sees what one
    over the whole group would, and only a row a bin meets per group. before, after: by
    column the aggregate of a bin and how bins combine: near (the next one), max or sum.
    No joins, so null keys are a group like others."""
    w = Window.partitionBy(*by)
    fold = {
        "near": lambda c, o: F.lag(c).over(o),
        "max": lambda c, o: F.max(c).over(o.rowsBetween(Window.unboundedPreceding, -1)),
        "sum": lambda c, o: F.sum(c).over(o.rowsBetween(Window.unboundedPreceding, -1)),
    }
    out = d.withColumn("__side", F.lit(0))
    for side, values, order in ((-1, before, w.orderBy("__bin")), (1, after, w.orderBy(F.desc("__bin")))):
        if values:
            per = d.groupBy(*by, "__bin").agg(*[v.alias(c) for c, (v, _) in values.items()])
            per = per.select(*by, "__bin", *[fold[how](c, order).alias(c) for c, (_, how) in values.items()], F.lit(side).alias("__side"))
            out = out.unionByName(per, allowMissingColumns=True)
    return out


def _in_bins(by: Sequence[str], *order: str):
    return Window.partitionBy(*by, "__bin").orderBy("__side", *order)


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], pos: str, payload: Sequence[str], strict: bool = False, width: int = WIDTH) -> DataFrame:
    """left with the payload of right's last row at or before (strict: before) its place.

    Both sides are merged in one sort by (by, bin of `width` places, pos); each bin gets
    the last row of those before it. Ties of right go to the largest payload. A row
    without a predecessor, or without a place, gets nulls; rows of right without a place
    match nothing; null keys equal each other. `width` bounds what meets in a task."""
    keys = [F.col(c) for c in (*by, pos)]
    rest = [c for c in left.columns if c not in (*by, pos)]
    one = left.select(*keys, F.struct(*rest).alias("__l") if rest else F.lit(None).alias("__l"), F.lit(None).cast(right.select(F.struct(*payload).alias("r")).schema["r"].dataType).alias("__r"), F.lit(0 if strict else 1).alias("__late"))
    two = right.where(F.col(pos).isNotNull()).select(*keys, F.lit(None).cast(one.schema["__l"].dataType).alias("__l"), F.struct(*payload).alias("__r"), F.lit(1 if strict else 0).alias("__late"))
    both = one.withColumn("__left", F.lit(True)).unionByName(two.withColumn("__left", F.lit(False))).withColumn("__bin", F.floor(F.col(pos) / width))
    both = _bordered(both, by, before={"__far": (F.max(F.when(~F.col("__left"), F.struct(pos, "__r"))), "max")})
    w = _in_bins(by, pos, "__late", "__r").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__last", F.last(F.coalesce("__r", "__far.__r"), ignorenulls=True).over(w)).where("__left")
    return both.select(*keys, *[F.col(f"__l.{c}").alias(c) for c in rest], *[F.col(f"__last.{c}").alias(c) for c in payload])


def edge_distance(points: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str], pos: str = "pos", start: str = "start", end: str = "end", width: int = 1000) -> DataFrame:
    """key, edge: the distance of each point to the nearer edge of its containers,
    min(pos - start, end - 1 - pos) over them; null outside of all."""
    near = F.least(F.col(pos) - F.col(start), F.col(end) - 1 - F.col(pos))
    hit = point_join(points, spans.select(*by, start, end), by, pos, start, end, width).groupBy(*key).agg(F.min(near).alias("edge"))
    return points.select(*key).distinct().join(hit, list(key), "left")


def _placed(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("__bin", F.floor(F.col(start) / width))


def _labelled(df: DataFrame, by: Sequence[str], start: str, end: str, gap: int, width: int) -> DataFrame:
    """df with __island, the start of the island that a row belongs to."""
    d = _bordered(_placed(df, start, end, width), by, before={end: (F.max(end), "max")})
    w = _in_bins(by, start, end)
    ends = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__new", F.when(ends.isNull() | (F.col(start) - ends > gap), F.col(start))).where("__side = 0")
    d = d.withColumn("__open", F.max("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = d.groupBy(*by, "__bin").agg(F.max("__new").alias("__new"))
    before = F.max("__new").over(Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__bin").alias("__of"), before.alias("__far"))
    cond = F.col("__bin") == F.col("__of")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return d.join(last, cond).withColumn("__island", F.coalesce("__open", "__far")).drop("__new", "__open", "__far", "__of", "__side", "__bin", *[f"__{c}" for c in by])


def islands(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", gap: int = 0, width: int = WIDTH, **aggs: Column) -> DataFrame:
    """Spans merged where start - (largest end so far) <= gap: by, start, end, n, aggs.

    Rows of one start are counted first (not with aggs, which need the rows); then spans
    that begin within `width` places meet in a task, and bins hand on their largest end
    and last island. Spans without a start or end are left out; end >= start."""
    more = [c.alias(k) for k, c in aggs.items()]
    d = df.withColumn("__n", F.lit(1)) if aggs else df.groupBy(*by, start).agg(F.max(end).alias(end), F.count_if(F.col(end).isNotNull()).alias("__n"))
    d = _labelled(d, by, start, end, gap, width)
    return d.groupBy(*by, "__island").agg(F.max(end).alias(end), F.sum("__n").alias("n"), *more).select(*by, F.col("__island").alias(start), end, "n", *aggs)


def coalesce_equal(df: DataFrame, by: Sequence[str], state: Sequence[str], start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """Adjacent pieces (previous end = start) of equal state joined into one: by, state,
    start, end, n. Pieces of a group don't overlap; null states equal each other. A
    piece's state and end are handed to the next bin of `width` places."""
    whole = F.struct(F.col(end).alias("e"), *[F.col(c).alias(f"s{i}") for i, c in enumerate(state)])
    d = _placed(df.withColumn("__piece", whole), start, end, width)
    d = _bordered(d, by, before={"__piece": (F.max_by("__piece", start), "near")})
    last = F.lag("__piece").over(_in_bins(by, start))
    same = last["e"] == F.col(start)
    for i, c in enumerate(state):
        same = same & last[f"s{i}"].eqNullSafe(F.col(c))
    d = d.withColumn("__long", F.when(F.coalesce(same, F.lit(False)), F.lit(None)).otherwise(F.col(start))).where("__side = 0")
    d = _bordered(d.drop("__side"), by, before={"__long": (F.max("__long"), "max")})
    d = d.withColumn("__run", F.max("__long").over(_in_bins(by, start).rowsBetween(Window.unboundedPreceding, 0))).where("__side = 0")
    return d.groupBy(*by, *state, "__run").agg(F.max(end).alias(end), F.count(F.lit(1)).alias("n")).select(*by, *state, F.col("__run").alias(start), end, "n")


def flanks(df: DataFrame, by: Sequence[str], reach: int, start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """Bands of `reach` on either side, cut where the previous or next span begins.

    In order of (start, end); spans without either are left out. Spans that begin within
    `width` places meet in a task; the neighbours across are handed on."""
    d = _placed(df, start, end, width)
    d = _bordered(d, by, before={end: (F.max_by(end, F.struct(start, end)), "near")}, after={start: (F.min(start), "near")})
    w = _in_bins(by, start, end)
    left = F.greatest(F.col(start) - reach, F.coalesce(F.lag(end).over(w), F.col(start) - reach))
    right = F.least(F.col(end) + reach, F.coalesce(F.lead(start).over(w), F.col(end) + reach))
    d = d.withColumn("left_start", F.least(left, F.col(start))).withColumn("right_end", F.greatest(right, F.col(end)))
    return d.where("__side = 0").drop("__side", "__bin")


def gaps(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """The space between consecutive spans: by, gap_start, gap_end. Of spans with one
    start only the longest can be before a gap; bins of `width` places hand on the next start."""
    d = df.groupBy(*by, start).agg(F.max(end).alias(end))
    d = _bordered(_placed(d, start, end, width), by, after={start: (F.min(start), "near")})
    d = d.withColumn("gap_end", F.lead(start).over(_in_bins(by, start))).where("__side = 0")
    return d.select(*by, F.col(end).alias("gap_start"), "gap_end").where("gap_end > gap_start")


def elementary(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """The pieces between all distinct cut points of a group's spans: by, start, end. Cuts
    within `width` places meet in a task; null cuts are left out."""
    cuts = df.select(*by, F.explode(F.array(start, end)).alias("start")).distinct()
    d = _bordered(_placed(cuts, "start", "start", width), by, after={"start": (F.min("start"), "near")})
    return d.withColumn("end", F.lead("start").over(_in_bins(by, "start"))).where("__side = 0 and end is not null").select(*by, "start", "end")


def depth(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """How many spans cover each elementary piece, by a running sum of +1 and -1, summed by
    place first; bins of `width` places hand on their sums. Spans without both ends are left out."""
    d = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    steps = d.select(*by, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))).alias("e")).select(*by, "e.at", "e.step")
    steps = steps.groupBy(*by, "at").agg(F.sum("step").alias("step"))
    steps = _bordered(_placed(steps, "at", "at", width), by, before={"step": (F.sum("step"), "sum")}, after={"at": (F.min("at"), "near")})
    w = _in_bins(by, "at")
    out = steps.withColumn("depth", F.sum("step").over(w)).withColumn("end", F.lead("at").over(w))
    return out.where("__side = 0 and end is not null").select(*by, F.col("at").alias("start"), "end", "depth")


def tiles(df: DataFrame, size: int, start: str = "start", end: str = "end") -> DataFrame:
    """Spans cut into tiles of `size` at most, none past the span's end."""
    d = df.where(F.col(end) > F.col(start)).withColumn("tile", F.explode(F.sequence(F.lit(0), F.floor((F.col(end) - F.col(start) - 1) / size))))
    return d.withColumn("tile_start", F.col(start) + F.col("tile") * size).withColumn("tile_end", F.least(F.col(end), F.col(start) + (F.col("tile") + 1) * size))


def chunks(df: DataFrame, length: str, size: int, overlap: int) -> DataFrame:
    """Chunks of `size` that overlap: chunk, chunk_start, chunk_end over [0, length)."""
    step = size - overlap
    d = df.where(F.col(length) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(length) - size) / step)).cast("int"))))
    return d.withColumn("chunk_start", F.col("chunk") * step).withColumn("chunk_end", F.least(F.col(length).cast("long"), F.col("chunk") * step + size).cast("long"))


def _first_come(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds kept to rows in order of group (all columns but the last three), start, end, key."""
    group, last = None, None
    for batch in batches:
        *by, key, starts, ends = (c.to_pylist() for c in batch.columns)
        kept = []
        for own, start, end in zip(zip(*by), starts, ends):
            if own != group:
                group, last = own, None
            kept.append(last is None or start >= last)
            if kept[-1]:
                last = end
        columns = [*batch.columns, pa.array(kept, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "kept"])


def greedy(df: DataFrame, by: Sequence[str], key: str, start: str = "start", end: str = "end", width: int = WIDTH) -> DataFrame:
    """First-come selection of spans that don't overlap, in order of (start, end, key):
    by, key, start, end, kept, the dropped ones too.

    Each decision needs the last kept end only, and none reaches past a place that no span
    crosses: islands go to the tasks, sorted, and pass by one row after the other, so the
    largest island must be sorted by a task but is held by none. Rows that tie in all three
    are alike. Spans without a start or end are left out; empty ones are kept where no kept
    one goes on. An empty table gives no rows."""
    d = _labelled(df.select(*by, key, start, end), by, start, end, -1, width).select(*by, "__island", key, start, end)
    order = [*by, "__island", start, end, key]
    schema = T.StructType([*d.schema.fields, T.StructField("kept", T.BooleanType())])
    picked = d.repartition(*by, "__island").sortWithinPartitions(*order).mapInArrow(_first_come, schema)
    return picked.select(*by, key, start, end, "kept")


def weighted_by_overlap(a: DataFrame, b: DataFrame, by: Sequence[str], value: str, key: Sequence[str], least: int = 0, width: int = 1000) -> DataFrame:
    """For each span of a the mean of b's value, weighted by overlap length; overlaps
    shorter than `least` don't count."""
    j = overlap_join(a, b, by, width)
    length = (F.least("end", "b_end") - F.greatest("start", "b_start"))
    j = j.withColumn("__len", length).where(F.col("__len") >= least)
    return j.groupBy(*key).agg((F.sum(F.col(f"b_{value}") * F.col("__len")) / F.sum("__len")).alias("weighted_mean"), F.sum("__len").cast("long").alias("covered"))
