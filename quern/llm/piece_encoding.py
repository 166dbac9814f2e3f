"""Encoding with byte-pair pieces, by backtracking, and decoding.

The model is a file of the sentencepiece library with merged pieces (BPE), byte
fallback and no normalization. The library merges, over and over, the two neighbours
whose joined piece scores highest. Here a text's pieces are found from left to right
instead: at each place the longest piece that starts there is tried (an Aho-Corasick
automaton over the reversed pieces gives these for all places in one pass); it is
taken if merging it together with the piece before it gives back these two, else the
next shorter one is tried; where none is left, the place is marked in a bitfield of
failed positions and the piece before is given up. A sequence in which every two
neighbours are compatible is the one that merging gives, so ids are exact.

Texts are cut where no piece of the model crosses, and what short parts encode to is
kept, in a bounded number of bytes.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._kept import Kept
from ._shared import small_batches, trimmed

SPACE = "▁"
IDS = np.dtype("<u4")
PAIRS_KEPT = 250_000  # about 25 MB
PARTS_BYTES = 56 << 20
UNKNOWN = -1
NO_PIECE = [(1, UNKNOWN)]
_COARSE = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_WHOLE = re.compile("(?s:.+)")


def _cut(pieces: list[str]) -> re.Pattern:
    """Matches parts of a text that no piece crosses: runs of letters, single digits and
    runs of others, each with the spaces before it; else parts between spaces; else all."""
    odd = re.escape("".join(sorted({c for p in pieces for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()})))
    fine = re.compile(f"{SPACE}*(?:[^\\W\\d_{odd}]+|\\d|(?:[^{SPACE}\\w]|[_{odd}])+)|{SPACE}+")
    return next(cut for cut in (fine, _COARSE, _WHOLE) if all(len(cut.findall(p)) == 1 for p in pieces))


class Pieces:
    """A model file's pieces, its ids of texts and its texts of ids."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = model.SentencePiece
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("the model must be one of merged pieces with byte fallback, without user-defined or unused pieces")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model must leave texts as they are, but for the space put before them")
        self.begin = self._control(model, model.trainer_spec.bos_piece)
        self.end = self._control(model, model.trainer_spec.eos_piece)
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.pieces = [p.piece for p in model.pieces]
        self.pairs, self.n_pairs = [{} for _ in self.pieces], 0
        if not {c for p in self.scores for c in p} <= self.scores.keys():
            raise ValueError("every character of a piece must be a piece itself")
        self.neighbours = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(model.pieces):
            if p.type == kinds.NORMAL and self.merged(p.piece) == [p.piece]:  # merging never ends with any other
                self.automaton.add_word(p.piece[::-1], (len(p.piece), i))
        self.automaton.make_automaton()
        self.cut = _cut(list(self.scores))
        self.byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.controls = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        self.spaced = {i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL and p.piece.startswith(SPACE)}
        self.surface = [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        for i, p in enumerate(model.pieces):
            if p.type != kinds.NORMAL:
                self.surface[i] = bytes([self.byte_of[i]]) if p.type == kinds.BYTE else model.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else b""
        self.kept = Kept(self._part, PARTS_BYTES)

    @staticmethod
    def _control(model, piece: str) -> int:
        return next(i for i, p in enumerate(model.pieces) if p.piece == piece)

    def merged(self, text: str) -> list[str]:
        """A short text's pieces by merging: always the pair that scores highest, the
        leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both pieces together gives back these two."""
        if self.n_pairs >= PAIRS_KEPT:
            self.pairs, self.n_pairs = [{} for _ in self.pieces], 0
        a, b = self.pieces[left], self.pieces[right]
        found = self.pairs[left][right] = a[-1] + b[0] not in self.neighbours or self.merged(a + b) == [a, b]
        self.n_pairs += 1
        return found

    def split(self, text: str) -> list[int]:
        """The pieces of a text (spaces as SPACE) as ids; UNKNOWN for a character that
        no piece has."""
        n = len(text)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # the pieces that start at each place, the longest first
        for last, piece in self.automaton.iter(text[::-1]):
            found[~last].append(piece)
        failed = bytearray(n // 8 + 1)
        ids: list[int] = []
        taken: list[tuple[int, int]] = []  # for each id its place and how many longer pieces were passed over
        at, k, before = 0, 0, UNKNOWN
        while at < n:
            here, known = found[at] or NO_PIECE, self.pairs[before].get
            for length, piece in here[k:] if k else here:
                end = at + length
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before < 0 or piece < 0:
                        break
                    fits = known(piece)
                    if fits or fits is None and self.compatible(before, piece):
                        break
                k += 1
            else:  # no piece fits here: give up the one before
                failed[at >> 3] |= 1 << (at & 7)
                ids.pop()
                at, k = taken.pop()
                k += 1
                before = ids[-1] if ids else UNKNOWN
                continue
            ids.append(piece)
            taken.append((at, k))
            at, k, before = end, 0, piece
        return ids

    def _part(self, text: str) -> bytes:
        ids = self.split(text)
        if UNKNOWN not in ids:
            return array("I", ids).tobytes()
        out, at = [], 0
        for i in ids:
            out += [i] if i >= 0 else [self.byte_ids[b] for b in text[at].encode()]
            at += len(self.pieces[i]) if i >= 0 else 1
        return array("I", out).tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids between the begin and the end id, 32 bits each, little-endian."""
        spaced = SPACE + text.replace(" ", SPACE) if text else ""
        return b"".join([np.array([self.begin], IDS).tobytes(), *map(self.kept.__getitem__, self.cut.findall(spaced)), np.array([self.end], IDS).tobytes()])

    def decode(self, ids: bytes) -> str:
        """The text of ids, as the library's decode gives it: without controls, without
        the space before the first piece; a byte that is no UTF-8 becomes U+FFFD."""
        listed = np.frombuffer(ids, IDS).tolist()
        try:
            parts = list(map(self.surface.__getitem__, listed))
        except IndexError:
            raise ValueError("an id is beyond the model's pieces") from None
        first = next((k for k, i in enumerate(listed) if i not in self.controls), None)
        if first is not None and listed[first] in self.spaced:
            parts[first] = parts[first][1:]
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
        runs = groupby(zip(listed, parts), lambda x: x[0] in self.byte_of)
        return "".join(_characters(b"".join(part for _, part in run)) for _, run in runs)


def _characters(run: bytes) -> str:
    """Bytes as text; each byte that starts no character is one U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _each(path: str, name: str, kind: pa.DataType, method: str) -> Callable:
    """Applies a method of Pieces to the second column, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = getattr(pieces(path), method)
        for batch in batches:
            made = pa.array([None if v is None else apply(v) for v in batch.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), made], [batch.schema.names[0], name])

    return trimmed(run)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ids (binary: 32-bit little-endian ids, the begin id first, the end id
    last) for each row of df.

    A null text is empty and has these two ids alone. Texts are encoded whole, however
    long: a text and its ids must fit in a worker's memory several times over. Ids of
    rows may be null or repeat, each row stays one. An empty table gives no rows. Other
    columns of df, whatever their names, are not read.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_each(model, "ids", pa.binary(), "encode"), f"id {rows.schema['id'].dataType.simpleString()}, ids binary").select(F.col("id").alias(id_col), "ids")


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and text for each row of df, from ids as encode() gives them.

    Null ids give a null text, no ids and controls alone an empty one. Ids that the
    model hasn't got raise an error. Rows that repeat stay; an empty table gives no
    rows. Other columns of df, whatever their names, are not read.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("binary").alias("ids"))
    return rows.mapInArrow(_each(model, "text", pa.string(), "decode"), f"id {rows.schema['id'].dataType.simpleString()}, text string").select(F.col("id").alias(id_col), "text")
