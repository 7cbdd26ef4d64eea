"""Numbering rows without ever putting all rows, or all rows of a group, in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.session import materialize

# monotonically_increasing_id() = partition index << 33 | position in the partition
_POSITION_BITS = 33
# rows of one group that a single task may sort
HOT_ROWS = 1_000_000


def as_columns(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def apart(column: Column | str) -> Column:
    """The same value, as a join key that needs an exchange of its own.

    Rows from a grouping or window are already partitioned by its key, and a join on that key
    would take them as they are. But adaptive execution splits a hot key of the other side, or
    turns to a broadcast, only where both sides come straight from an exchange. Spark does not
    see through ``greatest``, so the grouped (and by then small) side is exchanged once more.
    """
    column = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.greatest(column, column)


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of groups larger than ``hot_rows`` if there are any.

    Groups are counted by key alone, combined before the exchange. There are at most
    rows / ``hot_rows`` hot keys; they are written once so that both sides agree on them.
    """
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    hot = materialize(large.select(*[F.col(f"`{k}`").alias(f"_hot_{i}") for i, k in enumerate(keys)]), "hot-keys")
    if hot.isEmpty():
        return df, None
    match = reduce(lambda a, b: a & b, [df[f"`{k}`"].eqNullSafe(hot[f"_hot_{i}"]) for i, k in enumerate(keys)])
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi")


def number_rows(
    df: DataFrame,
    name: str,
    order_by: Sequence[str | Column] = (),
    group_by: Sequence[str] = (),
    start: int | Column = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the consecutive number of each row, overall or within ``group_by``.

    Ordinary groups are numbered by a window. Larger groups, and the input as a whole, are
    range-partitioned on the wanted order and written once with their place in it; counts
    per partition then give each partition its offset. So a group that holds a third of all
    rows is spread over many tasks. Without an order the rows stay where they are and only
    the counts move.
    """
    if group_by and not order_by:
        raise ValueError("numbering within groups needs an order")
    first = start if isinstance(start, Column) else F.lit(start)
    if not group_by:
        return _number_all(df, name, order_by, first)
    ordinary, hot = split_hot(df, group_by, hot_rows)
    place = F.row_number().over(Window.partitionBy(*group_by).orderBy(*as_columns(order_by)))
    numbered = ordinary.withColumn(name, (place - 1 + first).cast("bigint"))
    return numbered if hot is None else numbered.unionByName(_number_ranges(hot, name, order_by, group_by, first))


def _placed(df: DataFrame, sort: Sequence[Column]) -> DataFrame:
    """Rows with the partition (``_part``) and place (``_pos``) they have in the wanted order.

    Rows that tie on the order (exact copies, say) are spread by the partition they come
    from, so that a pile of copies does not become one range.
    """
    placed = df
    if sort:
        placed = (
            df.withColumn("_origin", F.spark_partition_id())
            .repartitionByRange(*sort, F.col("_origin"))
            .sortWithinPartitions(*sort)
            .drop("_origin")
        )
    placed = materialize(placed.withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.shiftright("_slot", _POSITION_BITS).alias("_part"),
        F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1).alias("_pos"),
    )


def _number_all(df: DataFrame, name: str, order_by: Sequence[str | Column], first: Column) -> DataFrame:
    placed = _placed(df, as_columns(order_by))
    # one row per partition, so the unpartitioned window and the broadcast stay small
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    )
    number = (F.col("_pos") + F.col("_before") + first).cast("bigint")
    return placed.join(F.broadcast(offsets), "_part").select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))


def _number_ranges(
    df: DataFrame, name: str, order_by: Sequence[str | Column], group_by: Sequence[str], first: Column
) -> DataFrame:
    placed = _placed(df, as_columns([*group_by, *order_by]))
    # a group has one row here per partition it touches
    upto = Window.partitionBy(*group_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        placed.groupBy("_part", *group_by)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_from"))
        .select(
            F.col("_part").alias("_span_part"),
            *[F.col(f"`{c}`").alias(f"_span_{i}") for i, c in enumerate(group_by)],
            (F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_from")).alias("_shift"),
        )
    )
    match = F.col("_part") == F.col("_span_part")
    for i, c in enumerate(group_by):
        match = match & F.col(f"`{c}`").eqNullSafe(F.col(f"_span_{i}"))
    number = (F.col("_pos") + F.col("_shift") + first).cast("bigint")
    return placed.join(spans, match).select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))


def surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str | Column] = (),
    existing: DataFrame | None = None,
    step: int = 1,
    start: int | Column = 1,
) -> DataFrame:
    """Consecutive keys from ``start`` on, or after the highest key of ``existing``."""
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(name), F.lit(0)) + 1).scalar()
    if step == 1:
        return number_rows(df, name, order_by, start=start)
    numbered = number_rows(df, name, order_by, start=0)
    first = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(name, first + F.col(name) * step)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark turns ``row_number() = 1`` into a group limit before the exchange, so every map
    task sends at most one row per key and a hot key does not pile up.
    """
    return rank_equals(df, keys, order_by, 1)


def rank_equals(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The n-th row of every key, with the same group limit before the exchange."""
    if not order_by:
        raise ValueError("picking a row per key needs an order")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*as_columns(order_by)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == n).drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], n: int, name: str) -> DataFrame:
    """The first ``n`` rows of every key with their rank."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*as_columns(order_by)))
    return df.withColumn(name, rank).filter(F.col(name) <= n)
