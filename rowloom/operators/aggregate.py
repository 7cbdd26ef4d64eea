"""Grouping, sorting, limits and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.flows import Flows
from rowloom.operators.keys import (
    HOT_ROWS,
    as_columns,
    first_per_key,
    number_rows,
    rank_equals,
    split_hot,
    top_per_key,
)

__all__ = [
    "aggregate", "distinct_rows", "unique_flows", "first_per_key", "rank_equals", "top_per_key", "value_counts",
    "joined_list", "rows_to_columns", "highest", "profile", "metered", "row_position", "sort_within_groups",
    "windowed_counts", "sort_rows", "top_rows", "page_rows", "random_rows", "unite", "difference",
]

# values joined at a time in a large group
_PIECE = 10_000

# Function names accepted in aggregate(), with the empty-input behaviour of SQL.
_FUNCTIONS = {
    "count": F.count,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
    "count_distinct": F.count_distinct,
    "stddev": F.stddev_samp,
}


def aggregate(df: DataFrame, by: Sequence[str | Column], outputs: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    """Group and aggregate; ``outputs`` maps an output name to (function, input).

    The input ``"*"`` counts rows. Sums and the like are combined before the exchange, so
    a hot group sends one row per task.
    """
    def build(function: str, source: str | Column) -> Column:
        if function not in _FUNCTIONS:
            raise ValueError(f"unknown aggregate {function!r}, use one of {sorted(_FUNCTIONS)}")
        value = F.lit(1) if isinstance(source, str) and source == "*" else source
        return _FUNCTIONS[function](F.col(value) if isinstance(value, str) else value)

    return df.groupBy(*by).agg(*[build(f, s).alias(n) for n, (f, s) in outputs.items()])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def unique_flows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], hot_rows: int = HOT_ROWS
) -> Flows:
    """First row per key, and all the others.

    The remaining columns break ties, so both flows take the same first row and together are
    the input. For the unique rows alone, ``first_per_key`` is cheaper.
    """
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    numbered = number_rows(df, "_nth", [*order_by, *[F.col(f"`{c}`") for c in sortable]], keys, hot_rows=hot_rows)
    return Flows(numbered.filter("_nth = 1").drop("_nth"), numbered.filter("_nth > 1").drop("_nth"))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def joined_list(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str,
    separator: str = ",",
    order_by: str | None = None,
    distinct: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Values of a group as one ordered, delimited text; null for a group of nulls only.

    ``distinct`` removes repeats before the exchange. The values of a large group are put
    in order over many tasks and joined piece by piece; only its text is ever in one place,
    and that has to fit one cell.
    """
    order = value if distinct or order_by is None else order_by
    source = df.select(*by, F.col(order).alias("_k"), F.col(value).alias("_v"))
    if distinct:
        source = source.distinct()

    def joined(rows: DataFrame, groups: Sequence[str], rank: Sequence[str], text: str) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct(*rank, F.col(text).alias("_text"))))
        return rows.groupBy(*groups).agg(
            F.when(F.count(text) > 0, F.array_join(F.transform(items, lambda i: i["_text"].cast("string")), separator)).alias(name)
        )

    ordinary, hot = split_hot(source, by, hot_rows)
    lists = joined(ordinary, by, ["_k"], "_v")
    if hot is None:
        return lists
    piece = F.floor(F.col("_n") / F.lit(_PIECE))
    placed = number_rows(hot, "_n", ["_k", "_v"], by, start=0, hot_rows=hot_rows).withColumn("_piece", piece)
    pieces = joined(placed, [*by, "_piece"], ["_n"], "_v")
    return lists.unionByName(joined(pieces.withColumnRenamed(name, "_part_text"), by, ["_piece"], "_part_text"))


def rows_to_columns(
    df: DataFrame, by: Sequence[str], pivot: str, values: Sequence[object], outputs: Mapping[str, Column]
) -> DataFrame:
    """Pivot on a stated list of values, so Spark needs no extra pass to find them."""
    grouped = df.groupBy(*by).pivot(pivot, list(values))
    return grouped.agg(*[c.alias(n) for n, c in outputs.items()])


def highest(df: DataFrame, column: str) -> DataFrame:
    """Highest value of a column, one row; null for an empty input."""
    return df.agg(F.max(column).alias(f"max_{column}"))


def profile(df: DataFrame) -> DataFrame:
    """Rows and nulls per column, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(df.columns)]
    )
    return counts.select("row_count", F.inline(per_column))


def metered(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs. Read ``.get`` of the second item afterwards."""
    seen = Observation(name)
    measures = {"rows": F.count(F.lit(1)), **measures}
    return df.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen


def row_position(df: DataFrame, name: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Row number over the whole input in a stated order."""
    return number_rows(df, name, order_by)


def sort_within_groups(
    df: DataFrame, groups: Sequence[str], order_by: Sequence[str | Column], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Position of every row in its group; large groups are spread over tasks."""
    return number_rows(df, name, order_by, groups, hot_rows=hot_rows)


def windowed_counts(df: DataFrame, ts: str, duration: str, slide: str | None, outputs: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Aggregates per time window (and ``by``); batch and streaming inputs alike."""
    span = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    grouped = df.groupBy(span.alias("_window"), *by).agg(*[c.alias(n) for n, c in outputs.items()])
    return grouped.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by, *outputs
    )


def sort_rows(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*as_columns(order_by))


def top_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows of an order; each task keeps only its own first ``n``."""
    return df.orderBy(*as_columns(order_by)).limit(n)


def page_rows(df: DataFrame, offset: int, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*as_columns(order_by)).limit(offset + n).offset(offset)


def random_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows in random order (all when there are fewer), the same for the same rows and
    seed however they are partitioned. Rows go by a seeded hash of all their columns, so equal rows
    stand together; each task keeps only its own first ``n``."""
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]))
    return drawn.orderBy("_draw").limit(n).drop("_draw")


def unite(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append by column name; columns one side lacks become null, repeats stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def difference(left: DataFrame, right: DataFrame, keep_repeats: bool = False) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks: as a set, or counting repeats."""
    return left.exceptAll(right) if keep_repeats else left.subtract(right)
