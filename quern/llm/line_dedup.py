"""Line dedup: a segment-partition edit join.

Lines within TAU edits agree on one of TAU + 1 even segments, at places that differ
by TAU at most. Each distinct line enters its segments into an index under (length,
segment number, content) and probes it, for each length up to TAU shorter or equal,
with the substrings that a segment of that length can have moved to. The pairs found
are verified with a banded bit-parallel edit distance: a column of the band is one
number, whose bits are the vertical differences of 2 * TAU + 1 neighbouring cells.

Copies of a line are one line first. Lines whose hash no other line shares, by a
Bloom filter as in exact dedup, pass straight through; only the others shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exact_dedup
from ._graph import components
from ._shared import materialize
from .decontam import small

TAU = 2
HEAD = 32
LETTERS = "etnhoasir"


def segment(length: str, k: str, parts: int) -> tuple[str, str]:
    """SQL for the start (from 0) and length of segment k of a line of `length` characters:
    even segments, the longer ones last."""
    short, many = f"(({length}) div {parts})", f"({parts} - ({length}) % {parts})"  # `many` segments are short
    return f"({k} * {short} + greatest(0, {k} - {many}))", f"({short} + if({k} >= {many}, 1, 0))"


def index_cells(tau: int = TAU) -> list[tuple[int, int, int, int]]:
    """shorter, k, move, how = -1 for a line's own segments."""
    return [(0, k, 0, -1) for k in range(tau + 1)]


def probe_cells(tau: int = TAU) -> list[tuple[int, int, int, int]]:
    """shorter, k, move, how = shorter: where segment k of a line that is `shorter` than
    this one, and within tau edits, can be found in this one.

    A match of segment k, k segments before it, is the first one that no edit
    touched: at most k edits lie before it and at most tau - k behind, so its place
    moves by at most k, and by at most tau - k relative to the end. A line's own
    segments (no shorter length, no move) are left to the index itself.
    """
    return [(d, k, m, d) for d in range(tau + 1) for k in range(tau + 1) for m in range(max(-k, d - (tau - k)), min(k, d + (tau - k)) + 1) if d or m]


def keyed(lines: DataFrame, cells: list[tuple[int, int, int, int]], tau: int, *columns: str) -> DataFrame:
    """columns, key, how for each line and cell that it has. The cells are exploded before
    their keys are worked out, which keeps the generated code small enough to compile."""
    cell = ", ".join(f"named_struct('d', {d}, 'k', {k}, 'm', {m}, 'how', {how})" for d, k, m, how in cells)
    rows = lines.select(*columns, "line", "n", F.explode(F.expr(f"array({cell})")).alias("c"))
    start, size = segment("n - c.d", "c.k", tau + 1)
    rows = rows.select(*columns, "line", "n", "c", F.expr(f"cast({start} + c.m as int)").alias("__at"), F.expr(f"cast({size} as int)").alias("__size"))
    rows = rows.where(f"n - c.d >= {tau + 1} and __at >= 0 and __at + __size <= n")
    return rows.select(*columns, F.expr("xxhash64(n - c.d, c.k, substring(line, __at + 1, __size))").alias("key"), F.col("c.how").alias("how"))


def _fold(a: str, b: str, tau: int, finish: str) -> Column:
    """The band moved over all columns of b, from left to right; finish: SQL of the state s."""
    width, top = 2 * tau + 1, 2 * tau
    full = (1 << width) - 1
    # p, q: characters; P: p behind tau cells that match nothing. The nested transforms
    # only name intermediate values: pm, d, hp, hn are the bit vectors of a column.
    step = f"""
        named_struct('c', s.c + if(j + {tau} <= m, 1 - (shiftright(d, {top}) & 1), 0) + if(j + {tau} > m,
                 (shiftright(hp, m - j + {tau}) & 1) - (shiftright(hn, m - j + {tau}) & 1), 0),
             'vp', (hn | (~(shiftright(d, 1) | hp))) & {full}, 'vn', shiftright(d, 1) & hp & {full})
    """
    pm = " | ".join(f"if(get(P, j - 1 + {i}) = q[j - 1], {1 << i}, 0)" for i in range(width))
    d = f"(((((pm & s.vp) + s.vp) ^ s.vp) | pm | s.vn) & {full})"
    named = f"""
      transform(array({pm}), pm ->
        transform(array({d}), d ->
          transform(array((s.vn | (~(d | s.vp))) & {full}), hp ->
            transform(array(d & s.vp), hn -> {step})[0])[0])[0])[0]
    """
    return F.expr(f"""
        transform(array(named_struct('p', filter(split({a}, ''), x -> x != ''), 'q', filter(split({b}, ''), x -> x != ''))), z ->
          transform(array(concat(array_repeat('', {tau}), z.p)), P ->
            transform(array(z.q), q ->
              transform(array(size(z.p)), m ->
                aggregate(if(size(q) = 0, array(), sequence(1, size(q))),
                  named_struct('c', least(m, {tau}), 'vp', {((1 << (tau + 1)) - 1) << tau}, 'vn', 0), (s, j) -> {named}, s -> {finish}))[0])[0])[0])[0]
    """)


def within(a: str = "x", b: str = "y", tau: int = TAU) -> Column:
    """The edit distance of two lines whose lengths differ by tau at most, or a number
    above tau if it is larger: Hyyrö's banded form of the bit-parallel algorithm.

    a and b name string columns. The band of column j has the rows j - tau .. j + tau;
    its lowest cell's value follows the diagonal to the last row and then goes along it.
    """
    return _fold(a, b, tau, "s.c")


def least_of_band(a: str, b: str, tau: int = TAU) -> Column:
    """The smallest value of the band's last column, where a has tau characters more than
    b: no line that goes on from a, b is nearer to each other."""
    cells = ["s.c"]
    for i in range(2 * tau - 1, -1, -1):
        cells.append(f"({cells[-1]} - (shiftright(s.vp, {i}) & 1) + (shiftright(s.vn, {i}) & 1))")
    return _fold(a, b, tau, f"least({', '.join(cells)})")


def common(a: str, b: str, behind: bool = False) -> Column:
    """How many characters (2**21 - 1 at most) two lines share at the start, or the end, by halving."""
    def cut(x: str) -> str:
        return f"substring({x}, length({x}) - p - k + 1, k)" if behind else f"substring({x}, p + 1, k)"

    powers = ", ".join(str(1 << i) for i in range(20, -1, -1))
    return F.expr(f"aggregate(array({powers}), 0, (p, k) -> p + if(p + k <= least(length({a}), length({b})) and {cut(a)} = {cut(b)}, k, 0))")


def bag(line: str = "line") -> Column:
    """How often a line has each of LETTERS (a byte each), 6 bits each, modulo 64."""
    return F.expr(" + ".join(f"cast((octet_length({line}) - octet_length(replace({line}, '{c}', ''))) % 64 as bigint) * {1 << (6 * i)}" for i, c in enumerate(LETTERS)))


def bags_near(a: str, b: str, most: str) -> str:
    """SQL: whether the counts of two bags differ by `most` at most, all together."""
    part = lambda i: f"abs((shiftright({a}, {6 * i}) & 63) - (shiftright({b}, {6 * i}) & 63))"
    return " + ".join(f"least({part(i)}, 64 - {part(i)})" for i in range(len(LETTERS))) + f" <= {most}"


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU) -> DataFrame:
    """One row for each line of df's texts: id_col, line_no, line_id, copies, n_links,
    class_id, kept.

    Lines are what line feeds part; those without a character other than white space
    are no lines here, nor is a null text's. line_id numbers the distinct lines and
    copies counts a line's rows; n_links is the number of other distinct lines within
    tau edits (of code points), all of them; class_id is the smallest line_id that
    links lead to; kept marks one row of each class, the first by id (null last), row
    and line. Lines of tau characters or fewer are all within tau edits of each other:
    they are one class, and their mutual links are counted, not made. An empty table
    gives no rows. Other columns of df are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line_no", "line"))
    rows = rows.where(F.ltrim("line", F.lit(" \t\r\x0b\x0c")) != "")
    rows = rows.select("id", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"), F.length("line").alias("n"), bag().alias("bag"), F.monotonically_increasing_id().alias("line_id"), "line")
    written = materialize(rows, "lines")  # the texts are cut once; what follows reads columns of this
    bits = exact_dedup.filter_bits(written.count())
    blocks = materialize(exact_dedup.repeated_slots(written, bits, "h1"), "line-bloom")
    maybe = exact_dedup.possibly_repeated(written.select("line_id", "h1", "h2"), blocks, bits, "h1").where("__maybe")
    groups = materialize(maybe.groupBy("h1", "h2").agg(F.min("line_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "rep", "copies"), "line-groups")
    copies = materialize(maybe.join(groups, F.expr("h1 = g1 and h2 = g2")).where("line_id != rep").select(F.col("line_id").alias("copy"), "rep"), "line-copies")
    lines = written.select("line_id", "line", "n", "bag").join(small(copies.select("copy")), F.col("line_id") == F.col("copy"), "left_anti")
    links = edit_links(lines, tau)
    short = materialize(lines.where(f"n <= {tau}").select("line_id"), "short-lines")
    few = short.agg(F.count(F.lit(1)), F.min("line_id")).first()
    roots = components(links.select("a", "b").union(short.where(f"line_id != {few[1]}").select(F.lit(few[1]).cast("long"), "line_id")) if few[0] else links, "a", "b")
    one = F.lit(1).cast("long")
    ends = links.select("a", one.alias("n")).union(links.select("b", one)).union(short.select("line_id", F.lit(few[0] - 1).cast("long")))
    degree = ends.groupBy("a").agg(F.sum("n").alias("n_links")).where("n_links > 0")
    linked = materialize(degree.join(roots, F.col("a") == F.col("node")).select(F.col("a").alias("linked"), "n_links", "root"), "linked-lines")
    places = written.select("id", "line_no", F.col("line_id").alias("place")).join(small(copies), F.col("place") == F.col("copy"), "left")
    places = places.select("id", "line_no", "place", F.coalesce("rep", "place").alias("line_id"))
    counts = groups.select(F.col("rep").alias("counted"), "copies")
    out = places.join(small(linked), F.col("line_id") == F.col("linked"), "left").join(small(counts), F.col("line_id") == F.col("counted"), "left")
    out = out.select("id", "line_no", "place", "line_id", F.coalesce("copies", one).alias("copies"), F.coalesce("n_links", one * 0).alias("n_links"), F.coalesce("root", "line_id").alias("class_id"), (F.col("linked").isNotNull() | F.col("counted").isNotNull()).alias("several"))
    # Only classes of several rows need their first row looked for.
    several = out.where("several")
    stays = materialize(several.groupBy(F.col("class_id").alias("c")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("stays")), "line-classes")
    out = out.join(small(stays), F.col("class_id") == F.col("c"), "left")
    return out.select(F.col("id").alias(id_col), "line_no", "line_id", "copies", "n_links", "class_id", F.coalesce(F.expr("place = stays.place"), F.lit(True)).alias("kept"))


def edit_links(lines: DataFrame, tau: int = TAU) -> DataFrame:
    """a < b, distance: all pairs of lines (line_id, line, n, bag; distinct) within tau
    edits, but for those of two lines of tau characters or fewer: all of these are."""
    long = lines.where(f"n > {tau}")
    index = keyed(long, index_cells(tau), tau, "line_id", "bag").select(F.col("line_id").alias("a"), F.col("bag").alias("bag_a"), "key")
    # A line probes under its own segments too (how = -1); of two lines that share one, the lesser is found.
    probes = keyed(long, index_cells(tau) + probe_cells(tau), tau, "line_id", "bag").select(F.col("line_id").alias("b"), F.col("bag").alias("bag_b"), F.col("key").alias("k"), "how")
    # An edit changes two counts by one, but one that changes the length only one.
    near = bags_near("bag_a", "bag_b", f"{2 * tau} - greatest(how, 0)")
    pairs = index.join(probes, F.expr(f"key = k and a != b and (how >= 0 or a < b) and {near}")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Of a line of more than tau characters, one that is within tau edits of it keeps one at least.
    letter = F.explode(F.array_distinct(F.filter(F.split("line", ""), lambda x: x != ""))).alias("letter")
    s = lines.where(f"n <= {tau}").select(F.col("line_id").alias("a"), F.col("n").alias("na"), letter)
    t = lines.where(f"n > {tau} and n <= {2 * tau}").select(F.col("line_id").alias("b"), F.col("n").alias("nb"), letter)
    pairs = pairs.union(s.join(t, "letter").where(f"nb - na <= {tau}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    pairs = materialize(pairs.distinct(), "line-pairs")
    used = materialize(pairs.select(F.col("a").alias("u")).union(pairs.select("b")).distinct(), "used-lines")
    texts = materialize(lines.join(small(used), F.col("line_id") == F.col("u"), "left_semi").select("line_id", "line", "n"), "pair-lines")
    both = pairs.join(texts.select(F.col("line_id").alias("a"), F.col("line").alias("x"), F.col("n").alias("nx")), "a").join(texts.select(F.col("line_id").alias("b"), F.col("line").alias("y"), F.col("n").alias("ny")), "b")
    # What is the same at the start is cut off; the band over the next HEAD characters tells most pairs apart.
    both = both.where(f"abs(nx - ny) <= {tau}").withColumn("p", common("x", "y"))
    both = both.select("a", "b", F.expr("substring(x, p + 1)").alias("x"), F.expr("substring(y, p + 1)").alias("y"))
    both = both.withColumn("hx", F.expr(f"substring(x, 1, {HEAD + tau})")).withColumn("hy", F.expr(f"substring(y, 1, {HEAD})"))
    # Written out, so that each step is taken once and pairs are dealt evenly.
    ahead = F.when((F.length("hx") == HEAD + tau) & (F.length("hy") == HEAD), least_of_band("hx", "hy", tau)).otherwise(0)
    both = materialize(both.withColumn("ahead", ahead).select("a", "b", "x", "y", "ahead"), "line-heads").where(f"ahead <= {tau}")
    both = both.withColumn("p", common("x", "y", True)).select("a", "b", F.expr("left(x, length(x) - p)").alias("x"), F.expr("left(y, length(y) - p)").alias("y"))
    return materialize(both.select("a", "b", within("x", "y", tau).alias("distance")).where(f"distance <= {tau}"), "line-links")
