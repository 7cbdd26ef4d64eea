"""Registration of queries with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The tables of one scale factor as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` as a query."""
    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return function

    return register
