"""Null handling and branching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: object) -> Column:
    """Columns as they are, names as columns; use ``F.lit`` for literals."""
    return F.col(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


def if_null(value: Column | str, default: object) -> Column:
    """NVL, ISNULL(a, b), IFNULL, VALUE."""
    return F.coalesce(as_col(value), default if isinstance(default, Column) else F.lit(default))


def null_switch(value: Column | str, present: object, absent: object) -> Column:
    """NVL2: one result when the value is there, another when it is null."""
    return F.when(as_col(value).isNotNull(), present).otherwise(absent)


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(as_col(value), F.lit(0))


def decode(value: Column | str, *pairs: object) -> Column:
    """DECODE(value, search, result, ..., default). A null search finds null values."""
    default = pairs[-1] if len(pairs) % 2 else None
    cases = pairs[:-1] if len(pairs) % 2 else pairs
    result = F
    for search, outcome in zip(cases[::2], cases[1::2]):
        search = search if isinstance(search, Column) else F.lit(search)
        result = result.when(as_col(value).eqNullSafe(search), outcome)
    return result.otherwise(default)


def iff(condition: Column, yes: object, no: object) -> Column:
    """IF, IFF. An unknown condition counts as false."""
    return F.when(condition, yes).otherwise(no)


def is_empty(value: Column | str) -> Column:
    """Null or of length zero."""
    return as_col(value).isNull() | (F.length(as_col(value)) == 0)


def is_null(value: Column | str) -> Column:
    return as_col(value).isNull()


def is_not_null(value: Column | str) -> Column:
    return as_col(value).isNotNull()
