"""MessagePack, to binary columns inside the JVM, and from them in Arrow batches.

Values are written as texts of hex digits, so that parts join by concat; packed() ends
with the bytes. unpacked() goes over each value's bytes once, with a stack of the open
arrays and maps.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from struct import unpack

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

OUT = "array<struct<path:string,kind:string,text:string,number:double>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hex(n: Column, digits: int) -> Column:
    """The low digits of a whole number, two's complement."""
    return F.right(F.lpad(F.hex(n.cast("long")), F.lit(16), F.lit("0")), F.lit(digits))


def _sized(n: Column, small: int, least: str, sizes: tuple[tuple[str, int], ...]) -> Column:
    """The head of something of size n: one byte below `small`, else a code and 1, 2 or 4 bytes."""
    out = F.concat(F.lit(sizes[-1][0]), _hex(n, 2 * sizes[-1][1]))
    for code, width in reversed(sizes[:-1]):
        out = F.when(n < 1 << 8 * width, F.concat(F.lit(code), _hex(n, 2 * width))).otherwise(out)
    return F.when(n < small, _hex(n + int(least, 16), 2)).otherwise(out) if small else out


def pack_text(s: Column) -> Column:
    body = F.hex(F.encode(s, "UTF-8"))
    head = _sized(F.octet_length(s), 32, "a0", (("D9", 1), ("DA", 2), ("DB", 4)))
    return F.coalesce(F.concat(head, body), F.lit("C0"))


def pack_bytes(b: Column) -> Column:
    return F.coalesce(F.concat(_sized(F.octet_length(b), 0, "00", (("C4", 1), ("C5", 2), ("C6", 4))), F.hex(b)), F.lit("C0"))


def pack_int(n: Column) -> Column:
    """The shortest form of a long."""
    up = F.when(n < 128, _hex(n, 2)).when(n < 1 << 8, F.concat(F.lit("CC"), _hex(n, 2))).when(n < 1 << 16, F.concat(F.lit("CD"), _hex(n, 4))).when(n < 1 << 32, F.concat(F.lit("CE"), _hex(n, 8))).otherwise(F.concat(F.lit("CF"), _hex(n, 16)))
    down = F.when(n >= -32, _hex(n, 2)).when(n >= -(1 << 7), F.concat(F.lit("D0"), _hex(n, 2))).when(n >= -(1 << 15), F.concat(F.lit("D1"), _hex(n, 4))).when(n >= -(1 << 31), F.concat(F.lit("D2"), _hex(n, 8))).otherwise(F.concat(F.lit("D3"), _hex(n, 16)))
    return F.when(n.isNull(), "C0").when(n >= 0, up).otherwise(down)


def pack_flag(b: Column) -> Column:
    return F.when(b.isNull(), "C0").when(b.cast("boolean"), "C3").otherwise("C2")


def pack_list(items: Column) -> Column:
    """An array of texts that pack_* made; null is nil."""
    return F.coalesce(F.concat(_sized(F.size(items), 16, "90", (("DC", 2), ("DD", 4))), F.array_join(items, "")), F.lit("C0"))


def pack_map(**values: Column) -> Column:
    n = F.lit(len(values))
    return F.concat(_sized(n, 16, "80", (("DE", 2), ("DF", 4))), *[x for k, v in values.items() for x in (pack_text(F.lit(k)), v)])


def packed(value: Column) -> Column:
    return F.unhex(value)


def _java_text(x: float) -> str:
    """A float as Spark writes it."""
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    if x != x or abs(x) == float("inf"):
        return {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}[repr(x)]
    digits, power = f"{Decimal(repr(x)).normalize():E}".split("E")
    return f"{digits if '.' in digits else digits + '.0'}E{int(power)}"


_KINDS = [next(kind for last, kind in ((0x7F, "int"), (0x8F, "map"), (0x9F, "array"), (0xBF, "str"), (0xC0, "nil"), (0xC1, "reserved"), (0xC3, "bool"), (0xC6, "bin"), (0xC9, "ext"), (0xCB, "float"), (0xD3, "int"), (0xD8, "ext"), (0xDB, "str"), (0xDD, "array"), (0xDF, "map"), (0xFF, "int")) if c <= last) for c in range(256)]
_WIDE = {first + i: w for first, widths in ((0xC4, (1, 2, 4)), (0xC7, (1, 2, 4)), (0xD9, (1, 2, 4)), (0xDC, (2, 4)), (0xDE, (2, 4))) for i, w in enumerate(widths)}  # bytes that give the length
_FIXED = {0xCA: 4, 0xCB: 8, **{0xCC + i: 1 << i for i in range(4)}, **{0xD0 + i: 1 << i for i in range(4)}, **{0xD4 + i: 1 + (1 << i) for i in range(5)}}


def contents(b: bytes) -> dict:
    """whole and values of unpacked()."""
    n, at, ok, out = len(b), 0, True, []
    stack: list[list] = []  # of the open maps and arrays: map, left, total, name
    while ok and at < n:
        c = b[at]
        kind, wide = _KINDS[c], _WIDE.get(c, 0)
        body = at + 1 + wide
        told = int.from_bytes(b[at + 1 : body]) if wide else c & 15 if 0x80 <= c <= 0x9F else c & 31 if 0xA0 <= c <= 0xBF else 0
        end = body + (told if kind in ("str", "bin") else told + 1 if kind == "ext" and wide else _FIXED.get(c, 0))
        if kind == "reserved" or end > n:
            ok = False
            break
        raw, text, number = b[body:end], None, None
        if kind == "str":
            text = raw.decode()
        elif kind == "int":
            whole = int.from_bytes(raw, signed=c >= 0xD0) if raw else c if c <= 0x7F else c - 256
            text, number = str(whole), float(whole)
        elif kind in ("map", "array"):
            text = str(told)
        elif kind in ("bin", "ext"):
            text = raw.hex()
        elif kind == "bool":
            text = "true" if c == 0xC3 else "false"
        elif kind == "float":
            (number,) = unpack(">f" if len(raw) == 4 else ">d", raw)
        nested, is_key = kind in ("map", "array"), False
        if stack:
            top = stack[-1]
            is_key = top[0] and top[1] % 2 == 0
            if is_key:
                top[3] = text if text is not None else kind if number is None else _java_text(number)
            elif not top[0]:
                top[3] = str(top[2] - top[1])
            top[1] -= 1
        if not is_key:
            out.append({"path": ".".join([x[3] for x in stack if x[3] is not None]), "kind": kind, "text": text, "number": number})
            if nested and told:
                items = told * 2 if kind == "map" else told
                stack.append([kind == "map", items, items, None])
        while stack and stack[-1][1] <= 0:  # what has no values left is closed, with all that ends with it
            stack.pop()
        ok, at = not (is_key and nested), end
    return {"whole": ok and not stack, "values": out}


def unpacked(b: Column) -> Column:
    """A binary value's contents: a struct of whole (every value is there, and nothing
    open or unknown) and values, an array of path, kind, text, number.

    A path is the map keys and array places that lead to a value, joined by dots; values
    next to each other outside of all maps and arrays have empty paths. An array or map
    stands before its values, its size as text. Texts and, as hex digits, bytes and
    extensions (type first) have text, whole numbers text and number, floats number.
    A map's key that is no text is taken by its text. What is cut off within a value ends
    there: the values before it are given and whole is false. Null gives null, no bytes
    give no values."""
    @F.pandas_udf(f"array<struct<whole:boolean,values:{OUT}>>")
    def read(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else [contents(v)] for v in values], dtype=object)

    return F.get(read(b), F.lit(0))
