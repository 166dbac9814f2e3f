"""A dataset manifest: Merkle trees over rows, with a proof for every row.

Each row is a leaf; each group (a source) is a tree of runs of 16 nodes, and the
groups' roots are the leaves of one more tree. A tree is worked on in aligned blocks
of 16^BLOCK_LEVELS leaves, each in one task: a block's root first, then the roots are
the nodes of the next table, until every tree has one. Proofs come back the same way:
in a block, Merkle's traversal goes from leaf to leaf. For each level it holds the
run of the present leaf, and a treehash stack that takes one leaf at each step and so
has the next run ready when it is due; what a task holds beside its block's leaves
grows with the logarithm of their number. The path above a block is the same for all
its leaves and is appended to theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import materialize, partitions, small_batches, trimmed
from .decontam import small

ARITY_BITS = 4
ARITY = 1 << ARITY_BITS
BLOCK_LEVELS = 3
# A proof's levels, from the leaf up: the run's nodes before the own one and after it, joined.
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_PATH_SQL = "array<struct<before: string, after: string>>"


def node(parts: list[str] | str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def row_digest(columns: list[Column]) -> Column:
    """sha256 of the columns' values as text, each as its number of UTF-8 bytes, ':' and
    the value; null is '-'."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


class TreeHash:
    """Nodes of one level, from leaves given one by one; a level's unfinished run is
    all that waits."""

    def __init__(self, level: int):
        self.runs: list[list[str]] = [[] for _ in range(level)]
        self.done: list[str] = []

    def push(self, leaf: str) -> None:
        for run in self.runs:
            run.append(leaf)
            if len(run) < ARITY:
                return
            leaf = node(run)
            run.clear()
        self.done.append(leaf)

    def finished(self) -> list[str]:
        """All nodes, the last one from fewer leaves if the leaves end here."""
        last = None
        for run in self.runs:
            if last is not None:
                run.append(last)
            last = node(run) if run else None
            run.clear()
        return self.done if last is None else [*self.done, last]


def root(leaves: list[str], levels: int) -> str:
    tree = TreeHash(levels)
    for leaf in leaves:
        tree.push(leaf)
    (top,) = tree.finished()
    return top


def traverse(leaves: list[str], levels: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf in turn its path: at each level the run's nodes before and after."""
    runs, ahead, path = [], [], []
    for level in range(levels):
        tree = TreeHash(level)
        for leaf in leaves[: ARITY ** (level + 1)]:
            tree.push(leaf)
        runs.append(tree.finished())
        ahead.append(TreeHash(level))
        path.append(("", ""))
    for i in range(len(leaves)):
        for level in range(levels):
            below, span = ARITY**level, ARITY ** (level + 1)
            if i and i % span == 0:  # the next run is due, and ready
                runs[level], ahead[level] = ahead[level].finished(), TreeHash(level)
            if i % below == 0:
                own = i // below % ARITY
                path[level] = ("".join(runs[level][:own]), "".join(runs[level][own + 1 :]))
            if i + span < len(leaves):
                ahead[level].push(leaves[i + span])
        yield list(path)


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its path give."""
    for before, after in path:
        leaf = node([before, leaf, after])
    return leaf


def siblings_digest(path: list[tuple[str, str]]) -> str:
    return node([part for level in path for part in level])


def _levels(count: int, most: int) -> int:
    """Levels within a block (of so many at most) of a tree of count leaves."""
    return next((h for h in range(most) if count <= ARITY**h), most)


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows (with a column tree) with at, the place in the tree by order, and count, the
    tree's rows. Rows are dealt by ranges of (tree, order) and written; a tree's places
    go on from one range to the next by the ranges' counts, a row for each tree and range."""
    by = [F.col("tree").asc_nulls_first(), *order]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    placed = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()), "merkle-rows")
    counts = placed.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("tree").alias("__tree"), F.col("__part").alias("__p"), (before - F.col("first")).alias("__shift"), F.sum("n").over(Window.partitionBy("tree")).alias("count"))
    joined = placed.join(small(materialize(starts, "merkle-starts")), F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn("at", F.col("__id") + F.col("__shift")).drop("__tree", "__p", "__part", "__id", "__shift")


def _blocks(nodes: DataFrame, most: int, above: DataFrame | None = None) -> DataFrame:
    """nodes (tree, at, count, node, ...), those of a block next to each other and in
    order; before them the block's own row in above (tree, at, path, subroot, root)."""
    rows = nodes.withColumn("block", F.expr(f"at div {ARITY**most}"))
    if above is not None:
        heads = above.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "path", "subroot", "root")
        rows = rows.unionByName(heads, allowMissingColumns=True)
    return rows.repartition(partitions(nodes.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "at")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _block_roots(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("count", pa.int64()), ("node", pa.string())])
    for rows in _gathered(batches):
        count = rows[0]["count"]
        top = root([r["node"] for r in rows], _levels(count, most))
        yield pa.RecordBatch.from_pylist([{"tree": rows[0]["tree"], "at": rows[0]["block"], "count": -(-count // ARITY**most), "node": top}], schema)


def _reduced(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Tables of nodes (tree, at, count, node): these, their blocks' roots, and so on to
    one node a tree. Their number is the logarithm of the largest tree's rows, base 16^most."""
    tables = [nodes]
    while not tables[-1].where("at > 0").isEmpty():
        found = _blocks(tables[-1].select("tree", "at", "count", "node"), most).mapInArrow(trimmed(partial(_block_roots, most)), "tree string, at long, count long, node string")
        tables.append(materialize(found, "merkle-roots"))
    return tables


def _block_paths(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("path", _PATH), ("subroot", pa.string()), ("root", pa.string())])
    for head, *rows in _gathered(batches):
        paths = traverse([r["node"] for r in rows], _levels(rows[0]["count"], most))
        made = [{"tree": r["tree"], "at": r["at"], "path": [{"before": b, "after": a} for b, a in p] + head["path"], "subroot": head["subroot"], "root": head["root"]} for r, p in zip(rows, paths)]
        yield pa.RecordBatch.from_pylist(made, schema)


def _paths(tables: list[DataFrame], most: int, above: DataFrame) -> DataFrame:
    """Paths of the nodes of the first table; above has those of the last one's."""
    for nodes in reversed(tables[:-1]):
        found = _blocks(nodes.select("tree", "at", "count", "node"), most, above).mapInArrow(trimmed(partial(_block_paths, most)), f"tree string, at long, path {_PATH_SQL}, subroot string, root string")
        above = materialize(found, "merkle-paths")
    return above


def _proofs(most: int, id_type: pa.DataType):
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([(n, id_type if n == "id" else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _gathered(batches):
            above = [(x["before"], x["after"]) for x in head["path"]]
            made = []
            for r, path in zip(rows, traverse([x["node"] for x in rows], _levels(rows[0]["count"], most))):
                path += above
                made.append(dict(zip(names, (r["id"], r["node"], head["subroot"], head["root"], siblings_digest(path), fold(r["claimed"], path)))))
            yield pa.RecordBatch.from_pylist(made, schema)

    return run


def manifest(df: DataFrame, leaf: Column, tree_col: str = "source", id_col: str = "doc_id", claimed: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """id_col, leaf, subroot, root, proof_sha256, folded_root, verified for each row of df.

    leaf (a digest as lowercase hex text) says what a row's leaf is; row_digest makes
    one. Leaves of a tree ascend by id (null first), then by leaf; trees by name (as
    text, null first). claimed is the leaf that is held against the manifest, leaf
    itself where it is null or not given: folded_root is the root that it gives with
    the row's proof, verified whether this is the root. proof_sha256 is the digest of
    all siblings from the leaf up. A tree may have one row, whose leaf is its subroot.
    Rows that repeat are leaves of their own. Texts of any length count by their digest
    alone. A task holds 16^block_levels leaves. An empty table gives no rows. Other columns of df, whatever their names, are
    not read.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(tree_col).cast("string").alias("tree"), F.col(id_col).alias("id"), leaf.alias("node"), (leaf if claimed is None else F.coalesce(claimed, leaf)).alias("claimed"))
    leaves = materialize(_ranked(rows, [F.col("id").asc_nulls_first(), F.col("node").asc()]), "merkle-leaves")
    trees = _reduced(leaves, block_levels)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    named = materialize(_ranked(subroots, [F.col("name").asc_nulls_first()]), "merkle-subroots")
    top = _reduced(named, block_levels)
    over = _paths(top, block_levels, top[-1].select("tree", "at", F.array().cast(_PATH_SQL).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root")))
    above = over.select("at", "path", "root").join(named.select("at", "name", F.col("node").alias("subroot")), "at").select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("at"), "path", "subroot", "root")
    blocks = _paths(trees[1:], block_levels, materialize(above, "merkle-trees"))
    id_kind = rows.schema["id"].dataType
    proven = _blocks(leaves.select("tree", "at", "count", "node", "id", "claimed"), block_levels, blocks).mapInArrow(trimmed(_proofs(block_levels, to_arrow_type(id_kind))), f"id {id_kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proven.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)
