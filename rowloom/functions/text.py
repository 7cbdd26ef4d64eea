"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.nulls import as_col


def trim(value: Column | str, chars: str | None = None, side: str = "both") -> Column:
    """TRIM and STRIP: blanks or the given characters, on both sides or one."""
    cut = {"both": F.btrim, "leading": F.ltrim, "trailing": F.rtrim}[side.lower()]
    return cut(as_col(value)) if chars is None else cut(as_col(value), F.lit(chars))


def upper(value: Column | str) -> Column:
    return F.upper(as_col(value))


def lower(value: Column | str) -> Column:
    return F.lower(as_col(value))


def left(value: Column | str, n: int) -> Column:
    return F.left(as_col(value), F.lit(n))


def right(value: Column | str, n: int) -> Column:
    return F.right(as_col(value), F.lit(n))


def substr(value: Column | str, start: int, length: int | None = None) -> Column:
    """SUBSTR: positions count from 1, and from the end when negative; 0 counts as 1."""
    text, start = as_col(value), start or 1
    size = F.length(text)
    first = F.lit(start) if start > 0 else size + start + 1
    rest = F.substring(text, first, size if length is None else F.lit(length))
    return F.when(first >= 1, rest) if start < 0 else rest


def length(value: Column | str) -> Column:
    return F.length(as_col(value))


def length_no_trailing(value: Column | str) -> Column:
    """LEN: trailing blanks do not count."""
    return F.length(F.rtrim(as_col(value)))


def position(value: Column | str, search: str | Column, start: int = 1) -> Column:
    """INSTR, LOCATE, CHARINDEX, POSSTR, INDEX: from 1, 0 when absent."""
    search = F.lit(search) if isinstance(search, str) else search
    return F.locate(search, as_col(value), F.lit(start)) if isinstance(start, Column) else F.position(
        search, as_col(value), F.lit(start)
    )


def replace(value: Column | str, search: str, put: str) -> Column:
    """Literal replacement."""
    return F.replace(as_col(value), F.lit(search), F.lit(put))


def overlay(value: Column | str, start: int, length: int, put: str) -> Column:
    """STUFF: put text in place of ``length`` characters; null when the start is outside."""
    text = as_col(value)
    inside = (F.lit(start) >= 1) & (F.lit(start) <= F.length(text)) & (F.lit(length) >= 0)
    return F.when(inside, F.overlay(text, F.lit(put), F.lit(start), F.lit(length)))


def concat(*values: Column | str, null_as_empty: bool = False) -> Column:
    """Null when a part is null, or without the null parts as some dialects do."""
    parts = [as_col(v) for v in values]
    return F.concat_ws("", *parts) if null_as_empty else F.concat(*parts)


def concat_ws(separator: str, *values: Column | str) -> Column:
    return F.concat_ws(separator, *[as_col(v) for v in values])


def pad(value: Column | str, n: int, fill: str = " ", side: str = "left") -> Column:
    return F.lpad(as_col(value), n, fill) if side == "left" else F.rpad(as_col(value), n, fill)


def reverse(value: Column | str) -> Column:
    return F.reverse(as_col(value))


def substring_index(value: Column | str, separator: str, count: int) -> Column:
    """Everything before the n-th separator, or after it counted from the end."""
    return F.substring_index(as_col(value), separator, count)


def edit_distance(a: Column | str, b: Column | str, limit: int | None = None) -> Column:
    return F.levenshtein(as_col(a), as_col(b), limit)


def phonetic(value: Column | str) -> Column:
    return F.soundex(as_col(value))
