"""Sequence edits that need a loop: Arrow-batched functions.

Each works on one row's own sequence; nothing is shared between rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import CODONS

def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


_TEXT, _LONG = T.StringType(), T.LongType()


def edit(seq: str | None, edits) -> tuple[str | None, int, list[str]]:
    """One pass from left to right over (pos from 0, ref, alt), in order. Refused, with a
    label: out_of_range, overlapping_edit, ref_mismatch, bad_allele; * changes nothing
    but counts. A null sequence stays null."""
    if seq is None:
        return None, 0, []
    out, at, applied, rejected = [], 0, 0, []
    for e in sorted(edits if edits is not None else [], key=lambda e: (e["pos"], e["ref"] or "", e["alt"] or "")):
        pos, ref, alt = e["pos"], e["ref"] or "", e["alt"] or ""
        if pos < 0 or pos + len(ref) > len(seq):
            rejected.append("out_of_range")
        elif pos < at:
            rejected.append("overlapping_edit")
        elif seq[pos : pos + len(ref)] != ref:
            rejected.append("ref_mismatch")
        elif alt == "*":
            applied += 1
        elif set(alt) - set("ACGTN"):
            rejected.append("bad_allele")
        else:
            out += [seq[at:pos], alt]
            at = pos + len(ref)
            applied += 1
    return "".join([*out, seq[at:]]), applied, rejected


@F.pandas_udf(_struct(seq=_TEXT, applied=T.IntegerType(), rejected=T.ArrayType(_TEXT)))
def apply_edits(seq: pd.Series, edits: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([edit(s, e) for s, e in zip(seq, edits)], columns=["seq", "applied", "rejected"])


def leftmost(seq: str, pos: int, ref: str, alt: str) -> tuple[int, str, str]:
    """The same change as far left as it can be written, each allele with a letter: a
    shared last letter goes, and an emptied allele takes the letter before."""
    if ref == alt:
        return pos, ref, alt
    while ref[-1:] == alt[-1:] and ref and alt:
        ref, alt = ref[:-1], alt[:-1]
        if not ref or not alt:
            if pos == 0:
                nxt = seq[len(ref)] if len(ref) < len(seq) else ""
                return pos, ref + nxt, alt + nxt
            pos -= 1
            ref, alt = seq[pos] + ref, seq[pos] + alt
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


@F.pandas_udf(_struct(pos=_LONG, ref=_TEXT, alt=_TEXT))
def left_align(seq: pd.Series, pos: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([leftmost(*x) for x in zip(seq, pos, ref, alt)], columns=["pos", "ref", "alt"])


def protein(seq: str) -> str:
    """Amino acids of the whole codons."""
    return "".join([CODONS.get(seq[i : i + 3], "X") for i in range(0, len(seq) - 2, 3)])


def classify(cds: str, tail: str, pos: int, ref: str, alt: str) -> tuple[str, str]:
    """What a change at pos (from 0) of a coding sequence does, and the mutant protein up
    to its stop, read on into the tail behind the sequence."""
    if cds[pos : pos + len(ref)] != ref:
        return "ref_mismatch", ""
    if len(cds) % 3:
        return "frame_unresolved", ""
    mutant = cds[:pos] + alt + cds[pos + len(ref) :]
    before, after = protein(cds), protein(mutant + tail)
    stop = after.find("*")
    shown = after if stop < 0 else after[:stop]
    own = before.rstrip("*")
    if before.endswith("*") and len(shown) > len(own) and shown.startswith(own) and (len(alt) - len(ref)) % 3 == 0:
        return "stop_loss", shown
    if before[:1] == "M" and after[:1] != "M":
        return "start_loss", shown
    if (len(alt) - len(ref)) % 3:
        return "frameshift", shown
    if shown == own:
        return "synonymous", shown
    if len(shown) < len(own) and own.startswith(shown):
        return "nonsense", shown
    if len(alt) == len(ref):
        return ("nonsense" if len(shown) < len(own) else "missense"), shown
    return ("inframe_deletion" if len(alt) < len(ref) else "inframe_insertion"), shown


@F.pandas_udf(_struct(consequence=_TEXT, protein=_TEXT))
def consequence(cds: pd.Series, tail: pd.Series, pos: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([classify(*x) for x in zip(cds, tail, pos, ref, alt)], columns=["consequence", "protein"])
