"""Aggregates over event time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.aggregate import windowed_counts


def stream_windows(
    df: DataFrame,
    ts: str,
    duration: str,
    outputs: Mapping[str, Column],
    *,
    late: str = "0 seconds",
    slide: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Window aggregates of a stream. State is kept until the watermark, ``late`` behind the
    newest time seen, passes the end of a window; later rows for it are dropped.

    Spark keeps watermarks on zoned timestamps only. A column without a zone is read in the
    session's zone (use UTC) and the window bounds are given back without one.
    """
    if df.schema[ts].dataType != T.TimestampNTZType():
        return windowed_counts(df.withWatermark(ts, late), ts, duration, slide, outputs, by)
    zoned = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counted = windowed_counts(zoned, ts, duration, slide, outputs, by)
    return counted.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
