"""Lines of the files that sinks write, and the sinks. Spark's commit protocol makes a
written folder appear whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import wrap


def text_of(*columns: Column | str) -> Column:
    """Columns as one tab-separated text; null is empty."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])


def write_table(df: DataFrame, path: str, gzip: bool = False) -> None:
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "")
    (w.option("compression", "gzip") if gzip else w).csv(path)


def write_lines(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """value in order: parts in order of their names, lines in order within."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def replace(df: DataFrame, path: str) -> None:
    """Write df as Parquet in place of what path holds, which df may read: written aside,
    then renamed. Readers never see a part of a table; between the two renames there is none
    at path, and after a crash just then the old one stands under path.old, the new one whole
    under path.new."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at, aside, old = (jvm.Path(path + x) for x in ("", ".new", ".old"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(f"{path}.new")
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, old)
    if not fs.rename(aside, at):
        raise OSError(f"cannot rename {path}.new")
    fs.delete(old, True)


def variant_line(chrom: str, pos: str, id_: str, ref: str, alt: str, info: Column, gt: Column) -> Column:
    return text_of(chrom, pos, id_, ref, alt, F.lit("."), F.lit("PASS"), info, F.lit("GT:AF"), gt)


def karyotypic(chrom: Column) -> Column:
    """1 to 22, then X, Y, M; others last."""
    bare = F.regexp_replace(chrom, "^chr", "")
    return F.when(bare.rlike("^[0-9]+$"), bare.try_cast("int")).when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25).otherwise(99)


def fasta(name: Column, seq: Column, width: int = 60) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), wrap(seq, width))


def fastq(name: Column, seq: Column, qual: Column) -> Column:
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def card(title: Column, **parts: Column) -> Column:
    """A few lines for people: the title, then key: value for what is there."""
    return F.concat_ws("\n", title, *[F.concat(F.lit(f"  {k}: "), v.cast("string")) for k, v in parts.items()])


def manifest(spark, path: str) -> DataFrame:
    """name, bytes, md5, sha256 of every file under a path."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.select("path", F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def bundle(spark, tables: dict[str, str]) -> DataFrame:
    """table, files, bytes, rows, sha256 of text tables (name: path): rows are the lines
    read back, sha256 is of the files' own, joined in order of their names."""
    out = []
    for name, path in tables.items():
        m = manifest(spark, path).where("name rlike '^part-'").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"), F.array_sort(F.collect_list(F.struct("name", "sha256"))).alias("s"))
        n = spark.read.text(path).agg(F.count(F.lit(1)).alias("rows"))
        out.append(m.crossJoin(n).select(F.lit(name).alias("table"), "files", "bytes", "rows", F.when(F.size("s") == 1, F.col("s")[0]["sha256"]).otherwise(F.sha2(F.array_join(F.transform("s", lambda x: x["sha256"]), ","), 256)).alias("sha256")))  # one row each
    return reduce(DataFrame.unionByName, out)


def inputs(spark, path: str, classes: dict[str, str], durable: str) -> DataFrame:
    """path, class (the first whose pattern finds it, else "other"), md5, durable (the
    pattern finds it) and complete (not empty, not a temporary name) of every file."""
    m = manifest(spark, path).where("not name rlike '^[_.]'")
    kind = F.lit("other")
    for name, pattern in reversed(classes.items()):
        kind = F.when(F.col("path").rlike(pattern), name).otherwise(kind)
    return m.select("path", kind.alias("class"), "md5", F.col("path").rlike(durable).alias("durable"), ((F.col("bytes") > 0) & ~F.col("name").rlike("[.]tmp$")).alias("complete"))
