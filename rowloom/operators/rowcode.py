"""Caller's own code on rows, for what column expressions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.keys import number_rows


def row_code(df: DataFrame, outputs: Mapping[str, Column]) -> DataFrame:
    """Row code as column expressions, which stay in the JVM."""
    return df.withColumns(dict(outputs))


def batch_code(df: DataFrame, name: str, code: Callable[..., pd.Series], inputs: Sequence[str], returns: str) -> DataFrame:
    """Row code as a function on Arrow batches of the named inputs."""
    return df.withColumn(name, F.pandas_udf(code, returns)(*inputs))


def staged_code(
    df: DataFrame,
    main: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
    start: Callable[[], object] = lambda: None,
    end: Callable[[object], pd.DataFrame | None] = lambda state: None,
) -> DataFrame:
    """Start, main and end code around the batches of every partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = start()
        for batch in batches:
            yield main(state, batch)
        last = end(state)
        if last is not None:
            yield last

    return df.mapInPandas(run, schema)


def running_number(df: DataFrame, name: str, order_by: Sequence[str | Column], start: int = 1) -> DataFrame:
    """A counter over all rows, which a per-partition variable could not give."""
    return number_rows(df, name, order_by, start=start)


def code_block(df: DataFrame, block: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return df.transform(block)
