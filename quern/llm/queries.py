"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact_dedup, line_dedup, merkle, mixing, near_dedup, piece_encoding, quality, secrets, snapshot_diff, suffix_dedup, token_output, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, shards = token_output.write_tokens(_table(spark, sf_dir, "documents"), word_tokenizer(), end_id=1)
    return token_output.read_tokens(spark, out, shards)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"))


LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document (by checksum of its id) is held against the manifest with its text in lower case."""
    docs = _table(spark, sf_dir, "documents")
    tampered = merkle.row_digest([F.translate(c, ascii_uppercase, ascii_lowercase) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, tampered)
    return merkle.manifest(docs, merkle.row_digest([F.col(c) for c in LEAF_COLUMNS]), claimed=claimed)


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = piece_encoding.encode(_table(spark, sf_dir, "documents"), piece_model())
    keyed = ids.select(F.struct("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")).alias("row"), "ids")
    return piece_encoding.decode(keyed, piece_model(), id_col="row").select("row.*", F.sha2("text", 256).alias("decoded_sha256"))


def later_snapshot(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source as they are later: by the checksum of the id modulo
    25, 0 goes, 1 to 4 change and 5 gets a copy; all others, null ids too, stay."""
    kind = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 25, F.lit(25))
    own, other = F.col("doc_id"), -1 - F.col("doc_id")
    ids = F.when(kind == 0, F.array().cast("array<long>")).when(kind.isin(3, 4), F.array(other)).when(kind == 5, F.array(own, other)).otherwise(F.array(own))
    text = F.when(kind == 1, F.concat(F.coalesce("text", F.lit("")), F.lit("+"))).otherwise(F.col("text"))
    lang = F.when(kind == 2, F.col("source")).otherwise(F.col("lang"))
    source = F.when(kind == 2, F.col("lang")).when(kind != 4, F.col("source"))
    return docs.select(F.explode(ids).alias("doc_id"), text.alias("text"), lang.alias("lang"), source.alias("source"))


def op13_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    row = F.sha2(F.concat_ws("\n", *[F.coalesce(c, F.lit("~")) for c in ("text", "lang", "source")]), 256)
    return snapshot_diff.snapshot_diff(docs, later_snapshot(docs), keep=row).withColumnRenamed("kept", "row_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_output": op2_token_output,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_secret_scan": op6_secret_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_piece_encoding": op12_piece_encoding,
    "op13_snapshot_diff": op13_snapshot_diff,
}

_OP7 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

_OP5 = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST(coalesce(length(regexp_replace(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+', '', 'g')), 0) AS DOUBLE) AS not_letters,
         CAST(coalesce(length(text), 0) AS DOUBLE) AS chars,
         CAST(coalesce(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')), 0) AS DOUBLE) AS seen,
         (CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u
  FROM documents),
k AS (SELECT *, -ln(u) / greatest(0.01::DOUBLE, ((chars - not_letters) / greatest(seen, 1)) * ((chars - not_letters) / greatest(seen, 1))) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE i % 3 WHEN 1 THEN 5.0 WHEN 2 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
        sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_w
      FROM w),
l AS (SELECT *, CASE WHEN (total - caps) / left_w * w <= cap THEN (total - caps) / left_w END AS fits FROM r),
t AS (SELECT source, source_size, least(cap, coalesce(max(fits) OVER () * w, cap)) AS target FROM l),
a AS (SELECT k.*, t.source_size, t.target,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, round(target) - epochs * source_size - ahead)) AS BIGINT) AS taken
FROM a
"""

_OP3 = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM dw),
grams AS (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS phrase FROM places, sizes WHERE s + size - 1 <= len(w)),
found AS (SELECT doc_id, s, win.size, item_id FROM grams JOIN win USING (phrase, size)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# crc32 of a text of ASCII digits: its table of 256 values from the rule, then a fold over the bytes.
_CRC32 = """
crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)) + 0 * z)) AS t),
crcs AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS crc
         FROM documents, crc_table)"""

_OP13 = f"""
WITH {_CRC32},
earlier AS (SELECT doc_id AS key, text, lang, source FROM documents),
kinds AS (SELECT d.*, coalesce(crc % 25, 25) AS kind FROM documents d LEFT JOIN crcs USING (doc_id)),
later AS (
  SELECT unnest(CASE WHEN kind = 0 THEN [] WHEN kind IN (3, 4) THEN [-1 - doc_id] WHEN kind = 5 THEN [doc_id, -1 - doc_id] ELSE [doc_id] END) AS key,
         CASE WHEN kind = 1 THEN coalesce(text, '') || '+' ELSE text END AS text, CASE WHEN kind = 2 THEN source ELSE lang END AS lang,
         CASE WHEN kind = 2 THEN lang WHEN kind <> 4 THEN source END AS source
  FROM kinds),
hashed AS (SELECT *, sha256(coalesce(text, '~') || chr(10) || coalesce(lang, '~') || chr(10) || coalesce(source, '~')) AS row_sha256 FROM later),
a AS (SELECT e.*, row_number() OVER (PARTITION BY text, lang ORDER BY key) AS i FROM earlier e WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.key IS NOT DISTINCT FROM e.key)),
b AS (SELECT l.*, row_number() OVER (PARTITION BY text, lang ORDER BY key DESC) AS i FROM hashed l WHERE NOT EXISTS (SELECT 1 FROM earlier e WHERE l.key IS NOT DISTINCT FROM e.key)),
pairs AS (
  SELECT l.key, e.key AS old_key, false AS by_content, row_sha256, concat_ws(',', CASE WHEN l.text IS DISTINCT FROM e.text THEN 'text' END, CASE WHEN l.lang IS DISTINCT FROM e.lang THEN 'lang' END, CASE WHEN l.source IS DISTINCT FROM e.source THEN 'source' END) AS changed
  FROM hashed l JOIN earlier e ON l.key IS NOT DISTINCT FROM e.key)
SELECT key, old_key, CASE WHEN changed = '' THEN 'same' ELSE 'update' END AS op, changed, row_sha256 FROM pairs
UNION ALL
SELECT coalesce(b.key, a.key), a.key, CASE WHEN a.i IS NULL THEN 'insert' WHEN b.i IS NULL THEN 'delete' ELSE 'rekey' END,
       CASE WHEN a.i IS NOT NULL AND b.i IS NOT NULL AND a.source IS DISTINCT FROM b.source THEN 'source' ELSE '' END, b.row_sha256
FROM a FULL JOIN b ON a.text IS NOT DISTINCT FROM b.text AND a.lang IS NOT DISTINCT FROM b.lang AND a.i = b.i
"""


def _merkle_levels(prefix: str, tree: str, levels: int) -> str:
    """Tables prefix_0 (tree, i, node, given) to prefix_levels: runs of 16 nodes become one until a tree has one."""
    out = []
    for k in range(levels):
        out.append(f"""
{prefix}_{k + 1} AS (
  SELECT {tree}, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
  FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {prefix}_{k}) GROUP BY {tree}, i // 16),
{prefix}_run_{k} AS (SELECT {tree}, i // 16 AS run, list(node ORDER BY i) AS nodes, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {prefix}_{k}) GROUP BY {tree}, i // 16)""")
    return ",".join(out)


def _merkle_folds(start: str, prefix: str, on: str, place: str, levels: int, begin: int) -> str:
    """Tables fold_begin+1 ...: each row's node and siblings, one level further up."""
    out, last = [], start
    for k in range(levels):
        j, shift = begin + k, 4 * k
        own = f"(({place} >> {shift}) & 15) + 1"
        out.append(f"""
fold_{j + 1} AS (
  SELECT f.* EXCLUDE (folded, proof),
         CASE WHEN r.n = 1 THEN folded ELSE sha256(array_to_string(nodes[1:({own}) - 1], '') || folded || array_to_string(nodes[({own}) + 1:], '')) END AS folded,
         CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(nodes[1:({own}) - 1], '') || array_to_string(nodes[({own}) + 1:], '') END AS proof
  FROM {last} f JOIN {prefix}_run_{k} r ON {on} AND r.run = {place} >> {shift + 4})""")
        last = f"fold_{j + 1}"
    return ",".join(out)


_LEAF = " || ".join(f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in LEAF_COLUMNS)
# 16^6 rows a source and 16^3 sources.
_OP11 = f"""
WITH {_CRC32},
leaves AS (SELECT doc_id, source, crc, sha256({_LEAF}) AS leaf, sha256({_LEAF.replace("CAST(text AS VARCHAR)", f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")}) AS tampered FROM documents LEFT JOIN crcs USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
rows_0 AS (SELECT source, pos AS i, leaf AS node FROM placed),{_merkle_levels("rows", "source", 6)},
tops_0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, node, source FROM rows_6),{_merkle_levels("tops", "tree", 3)},
fold_0 AS (SELECT p.*, t.i AS top, t.node AS subroot, CASE WHEN crc % 5 = 0 THEN tampered ELSE leaf END AS folded, '' AS proof
           FROM placed p JOIN tops_0 t ON p.source IS NOT DISTINCT FROM t.source),{_merkle_folds("fold_0", "rows", "f.source IS NOT DISTINCT FROM r.source", "pos", 6, 0)},{_merkle_folds("fold_6", "tops", "true", "top", 3, 6)}
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM fold_9, tops_3
"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": _OP3,
    "op5_mix_sources": _OP5,
    "op7_exact_dedup": _OP7,
    "op11_merkle_manifest": _OP11,
    "op13_snapshot_diff": _OP13,
}
