"""Tiers, parsers and small text functions, Column to Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(value: Column, bounds: Sequence[float], names: Sequence[str], inclusive: bool = False, missing: str | None = "na") -> Column:
    """names[i] for the first bound above (inclusive: at or above) the value, the last name beyond all."""
    out = F.when(value.isNull(), missing)
    for b, n in zip(bounds, names):
        out = out.when(value <= b if inclusive else value < b, n)
    return out.otherwise(names[len(bounds)])


def truth(text: Column) -> Column:
    """Whether a text says yes: 1, true or yes in any case; null and others don't."""
    return F.coalesce(F.lower(F.trim(text)).isin("1", "true", "yes"), F.lit(False))


def blank_to_null(text: Column, blanks: Sequence[str] = ("", "na", "NA", ".")) -> Column:
    return F.when(~text.isin(*blanks), text)


def key_values(**parts: Column) -> Column:
    """k=v;k=v of the values that are neither null nor empty, in order."""
    return F.concat_ws(";", *[F.when((v.cast("string") != ""), F.concat(F.lit(f"{k}="), v.cast("string"))) for k, v in parts.items()])


def parse_variant(text: Column) -> Column:
    """chr1:123G>A as a struct of chrom, pos, ref, alt; null fields where it isn't one."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"^(.*?):(\d+)(.*?)>(.*)$", i), F.lit(""))
    return F.struct(part(1).alias("chrom"), part(2).try_cast("long").alias("pos"), part(3).alias("ref"), part(4).alias("alt"))


def slug(text: Column) -> Column:
    """Letters, digits, dot, underscore and hyphen; others become _, outer _ go."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]", "_"), "^_+|_+$", "")


def unversioned(text: Column) -> Column:
    return F.substring_index(text, ".", 1)


def without_mate(name: Column) -> Column:
    return F.regexp_replace(name, "/[12]$", "")


def infix(name: Column, separator: str, text: str) -> Column:
    """text after the first separator; a name without one stays."""
    at = F.instr(name, separator)
    return F.when(at > 0, F.concat(F.substring(name, F.lit(1), at), F.lit(text), F.substring(name, at + 1, F.length(name)))).otherwise(name)


def log_bin(value: Column, low: float, step: float, n: int) -> Column:
    """Bins of equal ratio: 0 .. n - 1 by log10; null for values that aren't positive."""
    return F.when(value > 0, F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((F.log10(value) - low) / step))))


def linear_bin(value: Column, low: float, width: float, n: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((value - low) / width)))


def ordered_overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Bases that two half-open spans share."""
    return F.greatest(F.lit(0), F.least(end, other_end) - F.greatest(start, other_start))


def clean_pileup(bases: Column) -> Column:
    """Pileup bases, upper case, without read starts, ends and indel texts: a sign, a
    number of any digits, and as many letters as it says."""
    out = F.regexp_replace(F.regexp_replace(bases, r"\^.", ""), r"\$", "")
    number = lambda p: F.regexp_extract(p, "^[+-]([0-9]+)", 1)
    rest = lambda p: F.substring(p, F.length(number(p)) + 2 + number(p).cast("int"), F.length(p))
    pieces = F.transform(F.split(out, "(?=[+-][0-9])"), lambda p: F.when(p.rlike("^[+-][0-9]"), rest(p)).otherwise(p))
    return F.upper(F.array_join(pieces, ""))
