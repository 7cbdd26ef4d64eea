"""Lookups and joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.flows import Flows
from rowloom.operators.keys import apart, first_per_key

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


class Lookup(NamedTuple):
    """One lookup of a chain: table, key map main -> lookup, order that picks the match."""

    table: DataFrame
    on: Mapping[str, str]
    order_by: Sequence[str | Column] = ()
    how: str = "left"
    match: str = "first"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast after measuring that the side fits; leave it alone otherwise.

    The measuring job stops after ``max_rows + 1`` rows. A larger side is joined by
    shuffle, where adaptive execution splits hot keys.
    """
    def width(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("bigint")
        return F.lit(16).cast("bigint")

    row_bytes = reduce(lambda a, b: a + b, [width(f) for f in df.schema], F.lit(16).cast("bigint"))
    rows, size = (
        df.select(row_bytes.alias("w")).limit(max_rows + 1).agg(F.count("w"), F.coalesce(F.sum("w"), F.lit(0))).first()
    )
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def _condition(main: DataFrame, side: DataFrame, on: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [main[m] == side[k] for m, k in on.items()])


def lookup(
    main: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    *,
    how: str = "left",
    match: str = "first",
    order_by: Sequence[str | Column] = (),
    prefix: str = "lkp1_",
    broadcast: bool = False,
) -> Flows:
    """Join ``main`` to a lookup table and give the unmatched main rows as rejects.

    ``match="first"`` keeps one lookup row per key, chosen by ``order_by``; ``"all"``
    keeps every match. Lookup columns get ``prefix``; its key columns are dropped. A null
    key matches nothing, so such rows are rejects.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    if match not in ("first", "all"):
        raise ValueError(f"match must be first or all, not {match!r}")
    keys = list(on.values())
    first = match == "first"
    side = first_per_key(table, keys, order_by) if first else table
    side = side.select(
        *[(apart(k) if first else F.col(k)).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(prefix + c) for c in table.columns if c not in keys],
    )
    if broadcast:
        side = broadcast_if_small(side)
    renamed = {m: f"_key_{i}" for i, m in enumerate(on)}
    accepted = main.join(side, _condition(main, side, renamed), how).drop(*renamed.values())
    known = table.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    rejected = main.join(known, _condition(main, known, renamed), "left_anti")
    return Flows(accepted, rejected)


def lookup_chain(main: DataFrame, lookups: Sequence[Lookup], broadcast: bool = False) -> DataFrame:
    """Apply lookups one after the other; columns of the n-th get the prefix ``lkp<n>_``."""
    for n, step in enumerate(lookups, start=1):
        main = lookup(
            main, step.table, step.on, how=step.how, match=step.match,
            order_by=step.order_by, prefix=f"lkp{n}_", broadcast=broadcast,
        ).accepted
    return main


def equi_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join on differently named keys: inner, left, right, full, left_semi, left_anti.

    Spark cannot split a hot key of a full join, so that is done as a left join and the right
    rows without a match, which it can split both.
    """
    if how not in ("full", "outer", "full_outer"):
        return left.join(right, _condition(left, right, on), how)
    known = left.select(*on).distinct()
    known = known.select(*[apart(m).alias(f"_key_{i}") for i, m in enumerate(on)])
    unmatched = {f"_key_{i}": k for i, k in enumerate(on.values())}
    alone = right.join(known, _condition(known, right, unmatched), "left_anti")
    return left.join(right, _condition(left, right, on), "left").unionByName(alone, allowMissingColumns=True)


def semi_by_keys(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys_of``."""
    return df.join(keys_of.select(*keys), list(keys), "left_semi")


def missing_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source no longer has, as input for a delete."""
    return target.join(source.select(*keys), list(keys), "left_anti")
