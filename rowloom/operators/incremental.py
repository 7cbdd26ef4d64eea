"""Loads that move only what changed since the last run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import constants as C
from rowloom.operators.change import apply_action
from rowloom.operators.keys import first_per_key
from rowloom.operators.shape import audit_columns
from rowloom.session import materialize


class Load(NamedTuple):
    """New target, new control table and the changes that led to them."""

    target: DataFrame
    control: DataFrame | None
    changes: DataFrame


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], C.WATERMARK_COLUMNS)


def last_watermark(control: DataFrame, name: str) -> str:
    """Stored watermark of one table, read as a single value so that it can be pushed into
    the scan of the source."""
    row = control.filter(F.col("table_name") == name).agg(F.max("last_watermark")).first()
    return row[0] if row[0] is not None else C.FIRST_WATERMARK


def target_watermark(target: DataFrame | None, column: str) -> str:
    """Highest value loaded so far, or the first watermark when there is none."""
    value = target.agg(F.max(column).cast("string")).first()[0] if target is not None else None
    return value if value is not None else C.FIRST_WATERMARK


def changes_since(source: DataFrame, column: str, watermark: str, overlap: str | None = None) -> DataFrame:
    """Rows above the watermark.

    A row that shares the last timestamp but arrives later is missed by a strict test. An
    ``overlap`` such as ``"1 hour"`` reads that much again; the upsert makes it harmless. Numeric
    columns take a number as overlap and have no rows below the first watermark.
    """
    kind = source.schema[column].dataType
    numeric = isinstance(kind, T.NumericType)
    if numeric and watermark == C.FIRST_WATERMARK:
        return source.filter(F.col(column).isNotNull())
    bound = F.lit(watermark).cast(kind)
    if overlap is None:
        return source.filter(F.col(column) > bound)
    return source.filter(F.col(column) >= bound - F.expr(overlap if numeric else f"interval {overlap}"))


def watermark_load(
    source: DataFrame,
    target: DataFrame | None,
    control: DataFrame,
    name: str,
    keys: Sequence[str],
    column: str,
    now: dt.datetime,
    *,
    overlap: str | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> Load:
    """Extract above the stored watermark, upsert, and store the new maximum.

    Without changes neither the target nor the control table differs from before. The changes are
    read once and written to the shared folder: target and watermark come from the same rows, also
    when the source grows meanwhile.
    """
    changes = materialize(changes_since(source, column, last_watermark(control, name), overlap), "changes")
    new_target = apply_action(target, changes, keys, "UPSERT", order_by)
    newest = changes.agg(F.max(column).cast("string").alias("last_watermark")).filter("last_watermark is not null")
    newest = newest.select(
        F.lit(name).alias("table_name"), "last_watermark", C.clock(now).alias("updated_at")
    )
    both = control.withColumn("_new", F.lit(0)).unionByName(newest.withColumn("_new", F.lit(1)))
    return Load(new_target, first_per_key(both, ["table_name"], [F.desc("_new")]).drop("_new"), changes)


def target_max_load(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    column: str,
    now: dt.datetime,
    source_name: str,
    *,
    overlap: str | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> Load:
    """As above with the maximum of the target as watermark, and audit columns on the rows."""
    changes = changes_since(source, column, target_watermark(target, column), overlap)
    changes = materialize(audit_columns(changes, source_name, now, run_date=False), "changes")
    return Load(apply_action(target, changes, keys, "UPSERT", order_by), None, changes)


def date_slice(source: DataFrame, column: str, run_date: str, full: bool = False) -> tuple[DataFrame, str]:
    """Rows to load and the write mode: everything and overwrite, or from a date on and append."""
    if full:
        return source, "overwrite"
    return source.filter(F.col(column) >= F.lit(run_date).cast(source.schema[column].dataType)), "append"
