"""Secret scans with an incremental blob ledger.

A blob is a text under its sha256. The ledger is a folder with three Parquet tables:
blobs that rule versions have scanned (blob, rule), their findings, and the paths
(ids of rows, with the version that brought them) of each blob. A scan adds the
paths of a new version, scans only pairs of blob and rule version that the ledger
does not have, one text for each blob, and joins all findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import materialize, new_path, small_batches, trimmed

# The base rules, in the order in which kinds are listed.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 and more is found whole wherever it starts
# Kinds that this method adds, each with a rule version of its own.
MORE = {"pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "forge": r"\bgh[pousr]_[A-Za-z0-9]{36,}"}
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, *MORE)
RULES = {"base": 1, "more": 1}  # a changed rule set gets a higher number
SMALL = 1_000_000  # unseen blobs, of two numbers each, that are broadcast at most

_assign, _access, _hex = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)
_more = {k: re.compile(v) for k, v in MORE.items()}
_literals = {"pem": "PRIVATE KEY-----", "jwt": "eyJ", "forge": "gh"}
_keyword = re.compile(r"[:=]")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the base rules: per kind leftmost matches that do not
    overlap, without those that are too short. Offsets are code points."""
    out = []
    if _keyword.search(text):
        out += [(m.start(), m.end(), "assign") for m in _assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _access.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _hex.finditer(text)]
    return out


def more_spans(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), k) for k, p in _more.items() if _literals[k] in text for m in p.finditer(text)]


SCANS = {"base": base_spans, "more": more_spans}


def listed(spans) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def _scanner(names: list[str]):
    """Scans by those rules (of names) that a row's bits ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, rules, kinds, starts, ends = [], [], [], [], []
            for blob, text, todo in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for i, rule in enumerate(names):
                    if todo >> i & 1:
                        for s, e, k in SCANS[rule.split("@")[0]](text or ""):
                            blobs.append(blob), rules.append(rule), kinds.append(k), starts.append(s), ends.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(rules, pa.string()), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["blob", "rule", "kind", "start", "end"])

    return run


class Ledger:
    """A ledger in a folder that all executors share. A version's paths are written as
    a whole, in place of what an attempt before left; a finding that two attempts
    recorded counts once; blobs are recorded as scanned last. So a version that is
    added again, after a failure at any point, gives the same ledger."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "ledger")

    def _read(self, table: str, schema: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob binary, rule string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob binary, rule string, kind string, start long, `end` long")

    def paths(self, id_type: str = "long") -> DataFrame:
        return self._read("paths", f"id {id_type}, blob binary, version string")

    def add(self, df: DataFrame, version: str, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, int] | None = None) -> None:
        """Record a version of the rows of df and scan what no version had.

        A null text is empty. Rows that repeat, ids included, are one path each time; null
        ids are paths too. A version without rows has none, also if it had some before.
        """
        small_batches(self.spark)
        rules = [f"{k}@{v}" for k, v in (rules or RULES).items()]
        texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        rows = texts.withColumn("blob", F.unhex(F.sha2("text", 256)))
        id_type = rows.schema["id"].dataType.simpleString()
        rows.select("id", "blob").write.mode("overwrite").parquet(f"{self.path}/paths/version={quote(version, safe='')}")
        here = self.paths(id_type).where(F.col("version") == version).select("id", "blob")
        # One row stands for each blob; a hot blob's copies meet as digests, summed before the shuffle.
        todo = F.array(*[F.lit(r) for r in rules])
        new = here.groupBy("blob").agg(F.min("id").alias("id"))
        new = new.select("blob", "id", F.explode(todo).alias("rule")).join(self.scanned(), ["blob", "rule"], "left_anti")
        bit = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r), F.lit(1 << i).cast("long"))]), F.col("rule"))
        new = materialize(new.groupBy("blob", "id").agg(F.sum(bit).alias("todo")), "unseen")
        # Few unseen blobs go to the texts, as 64 bits of row and blob (a row too many, by chance, is
        # scanned and found again); many meet them in a shuffle.
        key = F.xxhash64("blob", "id")
        if new.count() <= SMALL:
            picked = rows.withColumn("__key", key).join(F.broadcast(new.select(key.alias("__key"), "todo")), "__key").select("blob", "text", "todo")
        else:
            first = new.select(F.col("id").alias("__id"), F.col("blob").alias("__blob"), "todo")
            picked = rows.join(first.hint("shuffle_hash"), F.expr("id <=> __id and blob = __blob")).select("blob", "text", "todo")
        found = picked.mapInArrow(trimmed(_scanner(rules)), "blob binary, rule string, kind string, start long, `end` long")
        found.distinct().write.mode("append").parquet(f"{self.path}/findings")
        done = F.explode(F.expr(f"filter(array({', '.join(f'if(todo & {1 << i} != 0, {chr(39)}{r}{chr(39)}, null)' for i, r in enumerate(rules))}), x -> x is not null)"))
        new.select("blob", done.alias("rule")).write.mode("append").parquet(f"{self.path}/scanned")

    def report(self, ids: DataFrame, version: str, id_col: str = "doc_id", rules: dict[str, int] | None = None) -> DataFrame:
        """The findings of a version's rows, joined back to every path: id_col,
        n_<kind> for every kind, base_sha256, spans. The findings of one blob, as many
        as its text has, meet in one row; a version that was not added has no rows."""
        rules = [f"{k}@{v}" for k, v in (rules or RULES).items()]
        rank = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col("kind"))
        one = F.struct("start", rank.alias("rank"), "end", "kind")
        text = "array_join(transform(%s, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
        by_blob = (
            self.findings().where(F.col("rule").isin(rules)).dropDuplicates(["blob", "kind", "start", "end"])
            .groupBy("blob").agg(F.sort_array(F.collect_list(one)).alias("all"))
            .select(F.col("blob").alias("__blob"), *[F.expr(f"cast(size(filter(all, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS],
                    F.expr(text % f"filter(all, x -> x.rank < {len(BASE_KINDS)})").alias("base"), F.expr(text % "all").alias("spans"))
        )
        id_type = ids.schema[id_col].dataType.simpleString()
        here = self.paths(id_type).where(F.col("version") == version)
        out = here.join(by_blob, F.col("blob") == F.col("__blob"), "left")
        zero = [F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS]
        return out.select(F.col("id").alias(id_col), *zero, F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: Ledger | None = None, version: str = "1") -> DataFrame:
    """Add df to a ledger as a version (a new ledger if none is given) and report on
    its rows. One row for each row of df; a null text is empty and has no findings;
    an empty table gives no rows; other columns of df are not read."""
    ledger = ledger or Ledger(df.sparkSession)
    ledger.add(df, version, id_col, text_col)
    return ledger.report(df, version, id_col)
