"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for every term of the benchmark, the places of the training texts
that have it: (row, pos, term), written to the shared folder. A phrase is found by
intersecting lists shifted by the terms' offsets, from the rarest term on: places
of the rarest are candidates for the phrase's start, those of the second rarest
confirm them, and the remaining terms are looked up for what is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize

WORDS = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = 1_000_000  # rows of two or three numbers, 24 MB, are broadcast at most


def words(text: Column) -> Column:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z in lower case; null has none."""
    parts = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower()), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def small(df: DataFrame) -> DataFrame:
    """df for a join: broadcast if it has at most SMALL rows (df must be written)."""
    return F.broadcast(df) if df.count() <= SMALL else df


@dataclass
class Index:
    """docs: row, doc_id, n_words; terms: term, word, n (places); postings: row, pos, term."""

    docs: DataFrame
    terms: DataFrame
    postings: DataFrame


def vocabulary(items: DataFrame, text_col: str = "text") -> DataFrame:
    """word, term (1, 2, ...) of all words of items."""
    every = items.select(F.explode(words(F.col(text_col))).alias("word")).distinct()
    return materialize(every.withColumn("term", F.monotonically_increasing_id() + 1), "vocabulary")


def build_index(df: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of df's texts for the words of terms (word, term)."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), words(F.col(text_col)).alias("words"))
    # An empty word ends each text: its place is the number of words, under term 0.
    lists = rows.select("row", "doc_id", F.posexplode(F.array_append("words", F.lit(""))).alias("pos", "word"))
    known = terms.select("word", "term").union(df.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast("long").alias("term")))
    known = F.broadcast(known) if terms.count() <= SMALL else known
    placed = lists.join(known, "word").select("row", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id"), "pos", "term")
    index = materialize(placed, "postings")
    postings = index.where("term > 0").select("row", "pos", "term")
    docs = index.where("term = 0").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return Index(docs, materialize(terms.join(counts, "term").select("term", "word", "n"), "terms"), postings)


def phrases(items: DataFrame, index: Index, n: int = WORDS, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Windows of n consecutive item words, or the whole item if it has fewer, but some.

    (phrase, size, terms) with terms = [(n, offset, term), ...] from the rarest on,
    and (phrase, item). Windows with a word that no text has are not listed.
    """
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - n))
    windows = w.select("item", F.explode(F.transform(starts, lambda s: F.slice(F.col("words"), s + 1, n))).alias("words"))
    of_item = windows.select(F.array_join("words", " ").alias("phrase"), "item").distinct()
    flat = of_item.select("phrase").distinct().select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "word"))
    flat = flat.join(index.terms, "word", "left").groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("terms"), F.count("term").alias("known"), F.count(F.lit(1)).cast("int").alias("size"))
    flat = materialize(flat.where("known = size").select(F.xxhash64("phrase").alias("phrase"), "size", "terms"), "phrases")
    return flat, materialize(of_item.select(F.xxhash64("phrase").alias("phrase"), "item"), "phrase-items")


def phrase_matches(index: Index, flat: DataFrame) -> DataFrame:
    """(row, start, phrase, size) of every occurrence of the phrases in the index."""
    def nth(k: int) -> DataFrame:
        return flat.where(F.size("terms") > k).select("phrase", "size", F.expr(f"terms[{k}].offset").alias("offset"), F.expr(f"terms[{k}].term").alias("term"))

    rarest = materialize(nth(0), "rarest")
    starts = index.postings.join(small(rarest), "term").where("pos >= offset").select("row", (F.col("pos") - F.col("offset")).alias("start"), "phrase", "size")
    # Second rarest: of its lists only those in question, joined by place.
    second = materialize(nth(1), "second")
    terms = materialize(second.select("term").distinct(), "second-terms")
    lists = index.postings.join(small(terms), "term", "left_semi").select(F.col("row").alias("r"), F.col("pos").alias("p"), F.col("term").alias("t"))
    asked = starts.where("size > 1").join(small(second.drop("size")), "phrase").select("row", "start", "phrase", "size", (F.col("start") + F.col("offset")).alias("pos"), "term")
    left = asked.join(lists, F.expr("row = r and pos = p and term = t")).select("row", "start", "phrase", "size")
    left = materialize(left, "candidates")
    # The rest of the terms: the lists of the texts that still have candidates.
    asked = left.where("size > 2").join(small(flat.drop("size")), "phrase")
    asked = asked.select("row", "start", "phrase", "size", F.explode(F.slice("terms", F.lit(3), F.col("size"))).alias("x"))
    asked = asked.select("row", "start", "phrase", "size", (F.col("start") + F.col("x.offset")).alias("pos"), F.col("x.term").alias("term"))
    rows = materialize(left.select("row").distinct(), "candidate-rows")
    lists = index.postings.join(small(rows), "row", "left_semi").select(F.col("row").alias("r"), F.col("pos").alias("p"), F.col("term").alias("t"))
    long = asked.join(lists, F.expr("row = r and pos = p and term = t")).groupBy("row", "start", "phrase", "size").agg(F.count(F.lit(1)).alias("found")).where("found = size - 2")
    short = starts.where("size = 1").union(left.where("size = 2"))
    return materialize(long.select("row", "start", "phrase", "size").union(short), "matches")


def proximity_matches(index: Index, pairs: DataFrame, within: int = WORDS, both: bool = False) -> DataFrame:
    """(row, query, pos, other): places of word a and the nearest earlier or same
    place of word b, at most `within` words before. both: also the nearest later
    place, at most `within` words after, as a row of its own. pairs: query, a, b (words).

    Lists are merged in order of place, text by text: linear in their lengths."""
    named = index.terms.select("word", "term")
    asked = pairs.select("query", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("word")), F.struct(F.lit(1).alias("side"), F.col("b").alias("word")))).alias("x"))
    asked = materialize(asked.select("query", "x.side", "x.word").join(named, "word").select("query", "side", "term"), "asked")
    both_sides = index.postings.join(small(asked), "term")
    order = Window.partitionBy("row", "query").orderBy("pos", F.col("side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    merged = both_sides.withColumn("other", F.last(F.when(F.col("side") == 1, F.col("pos")), ignorenulls=True).over(order))
    before = merged.where(f"side = 0 and pos - other <= {int(within)}").select("row", "query", "pos", "other")
    if not both:
        return before
    # From the end on; a place of b that is the same is one of `before`.
    order = Window.partitionBy("row", "query").orderBy(F.col("pos").desc(), "side").rowsBetween(Window.unboundedPreceding, 0)
    merged = both_sides.withColumn("other", F.last(F.when(F.col("side") == 1, F.col("pos")), ignorenulls=True).over(order))
    return before.union(merged.where(f"side = 0 and other - pos <= {int(within)}").select("row", "query", "pos", "other"))


def decontaminate(df: DataFrame, items: DataFrame, n: int = WORDS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of df: id_col, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit: words inside any occurrence of a window of an item; n_items: items with
    occurring windows; items_sha256: of their ids, sorted as strings, comma-joined.
    Items that share an id are one item; a null item id is an empty string. Null
    texts have no words; rows that repeat, ids included, are rows of their own. No
    items: nothing is hit. An empty df gives no rows. Other columns are not read.
    """
    index = build_index(df, vocabulary(items, item_text), id_col, text_col)
    flat, of_item = phrases(items, index, n, item_col, item_text)
    found = phrase_matches(index, flat)
    hit = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
    hit = hit.groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    pairs = found.select("row", "phrase").distinct().join(small(of_item), "phrase").select("row", "item").distinct()
    named = pairs.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = index.docs.join(hit, "row", "left").join(named, "row", "left")
    zero = F.lit(0).cast("long")
    ids = F.coalesce(F.array_join("items", ","), F.lit(""))
    return out.select(F.col("doc_id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce(F.size("items").cast("long"), zero).alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated"))
