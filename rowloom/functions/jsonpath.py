"""Values inside JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.nulls import as_col


def path(value: Column | str, *keys: str | int) -> Column:
    """``col:key`` and ``col->>'key'``: a nested value as text, null when absent."""
    steps = "".join(f"[{k}]" if isinstance(k, int) else f"['{k}']" for k in keys)
    return F.get_json_object(as_col(value), "$" + steps)


def typed_path(value: Column | str, expression: str, to: str) -> Column:
    """A nested value with a type, through Spark's variant; null when it does not fit."""
    return F.try_variant_get(F.try_parse_json(as_col(value)), expression, to)


def items(value: Column | str, element: str = "string") -> Column:
    """Elements of a JSON array, for ``F.explode``."""
    return F.from_json(as_col(value), f"array<{element}>")


def entries(value: Column | str) -> Column:
    """Keys and values of a JSON object, for ``F.explode``."""
    return F.from_json(as_col(value), "map<string,string>")
