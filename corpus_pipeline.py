"""A corpus pipeline of five stages: STAGES in order, each a function of
(spark, docs, sf_dir); a stage's rows are written as Parquet and read again as the
next one's docs. All stages but the last return the columns of documents.

A stage tells rows apart by the file and the place in it that they come from, so ids
that are null or repeat, and extra columns, do no harm, and no text is written twice.
A stage's own tables are deleted when it returns, but for the small one that says
which rows go; nothing that an earlier call returned is touched.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import _shared, decontam, mixing, near_dedup, queries, token_output, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """docs under __row: the file (64 bits of its path) and the place in it. A table
    that no file stands behind is written first."""
    row = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")).alias("__row")
    try:
        return docs.select(row, *COLUMNS)
    except AnalysisException:
        return _shared.materialize(docs.select(*COLUMNS), "stage").select(row, *COLUMNS)


def _decided(spark: SparkSession, decide) -> DataFrame:
    """The table that decide() returns, written; all else that it wrote is deleted."""
    with _shared.leaving(spark) as kept:
        path = _shared.new_path(spark, "decided")
        kept.add(path)
        decided = decide()
        decided.write.parquet(path)
    return spark.read.schema(decided.schema).parquet(path)


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """rows whose number is not in dropped (column __row); texts move only where
    dropped is too large to broadcast."""
    return rows.join(decontam.small(dropped), "__row", "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    The model learns from the documents that labels names. Each row is scored by its
    whole text, however long, on its own: rows that repeat stay or go together. A null
    or empty text has the bias's score and stays, as does everything where there are
    no labels. Null ids are no examples. An empty table gives no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with _shared.leaving(spark):
        model = toxicity.fit(docs, labels, "toxic", toxicity.fold("doc_id", toxicity.FOLDS) != toxicity.HELD_OUT)
    return toxicity.keep(docs.select(*COLUMNS), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the first by file and place.

    Texts without words (null, empty, white space) are one group each by their exact
    text, null with the empty one; shorter texts than a shingle are one shingle; whole
    texts are compared. Of rows that repeat, one stays. An empty table gives no rows.
    """
    rows = _numbered(docs)
    return _without(rows, _decided(spark, lambda: near_dedup.near_dedup(rows, id_col="__row").where("not kept").select("__row")))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A text that is null, empty or without words stays; a very long one goes for one
    passage anywhere in it; rows that repeat stay or go together. Where the benchmark
    has no items all stay. An empty table gives no rows.
    """
    rows = _numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(rows, _decided(spark, lambda: decontam.decontaminate(rows, items, id_col="__row").where("contaminated").select("__row")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its whole copies, and one more if
    at least half of its words are in the fractional selection.

    Texts stay whole; those without words (null, empty) weigh nothing and stay once.
    A null source is a source of its own, the last one. Rows draw by doc_id (null: as
    an empty one), so ties, rows that repeat included, draw alike and are taken in
    order of size, file and place. An empty table gives no rows.
    """
    rows = _numbered(docs)

    def decide() -> DataFrame:
        taken = mixing.mix(rows.withColumn("__draw", F.col("doc_id")), id_col="__row", draw_col="__draw")
        copies = F.when(F.col("size") == 0, 1).otherwise(F.col("epochs") + (F.col("part") * 2 >= F.col("size")).cast("long"))
        return taken.select("__row", copies.cast("int").alias("__times")).where("__times > 0")

    times = _decided(spark, decide)
    return rows.join(decontam.small(times), "__row").select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), F.col("__times"))).alias("__copy")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row for each document in them: doc_id, start,
    n_tokens, ids_crc32. A null or empty text is the end id alone; rows that repeat
    are documents of their own; null ids come first; very long texts are encoded
    whole. An empty table gives no rows."""
    out, shards = token_output.write_tokens(docs, queries.word_tokenizer(), end_id=1)
    return token_output.read_tokens(spark, out, shards, docs.schema["doc_id"].dataType.simpleString())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_output", tokens),
]

#: Learned scores, signatures and a tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents. What a stage wrote is deleted when the next
    one's rows are written; what stays are the token files that the result reads."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with _shared.recording() as here:
            docs = _shared.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        for path in before:
            _shared.remove(spark, path)
        before = here
    out = STAGES[-1][1](spark, docs, sf_dir)  # its files are written by now
    for path in before:
        _shared.remove(spark, path)
    return out
