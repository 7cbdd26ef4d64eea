"""Helpers around rows of any shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that work columns cannot clash with its names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The packed row's columns again, and ``more``."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *more)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(column: str) -> Column:
    """crc32 of the value as text; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
