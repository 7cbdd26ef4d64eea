"""Streaming queries: the events table read as a file stream and run to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.streaming.sources import load_available, read_file_stream
from rowloom.streaming.upsert import compact, stream_upsert, upsert_state
from rowloom.streaming.windows import stream_windows


def _events(t: Tables) -> DataFrame:
    # a pattern, because the stream source takes a folder or a pattern and the table may be one file
    return read_file_stream(t.spark, f"{t.dir}/[e]vents.parquet", t.events.schema)


@query("available_now_load", "SELECT * FROM events")
def available_now_load(t: Tables) -> DataFrame:
    path, checkpoint = scratch_path(t.spark, "loaded"), scratch_path(t.spark, "loaded-state")
    load_available(_events(t), path, checkpoint)
    load_available(_events(t), path, checkpoint)  # the second run finds nothing new
    return t.spark.read.schema(t.events.schema).parquet(path)


_LATEST = """
SELECT user_id, event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def _upserted(t: Tables) -> tuple[str, list]:
    path, checkpoint = scratch_path(t.spark, "changes"), scratch_path(t.spark, "changes-state")
    newest = [F.desc("ts"), F.desc("event_id")]
    changes = _events(t).select("user_id", "event_id", "event_type", "ts")
    stream_upsert(changes, path, checkpoint, ["user_id"], newest).awaitTermination()
    return path, newest


@query("stream_upsert", _LATEST)
def upserted(t: Tables) -> DataFrame:
    path, newest = _upserted(t)
    return upsert_state(t.spark, path, ["user_id"], newest)


@query("stream_upsert_compacted", _LATEST)
def upserted_compacted(t: Tables) -> DataFrame:
    path, newest = _upserted(t)
    folded = scratch_path(t.spark, "folded")
    compact(t.spark, path, folded, ["user_id"], newest)
    return upsert_state(t.spark, folded, ["user_id"], newest)


@query("stream_windows", """
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         event_type, count(*) AS n, max(value) AS top FROM events GROUP BY ALL)
WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 minutes' FROM events)
""")
def windows(t: Tables) -> DataFrame:
    """Windows the watermark has closed when the stream ends."""
    path, checkpoint = scratch_path(t.spark, "windows"), scratch_path(t.spark, "windows-state")
    counted = stream_windows(
        _events(t), "ts", "1 hour", {"n": F.count(F.lit(1)), "top": F.max("value")}, late="10 minutes", by=["event_type"]
    )
    load_available(counted, path, checkpoint)
    return t.spark.read.schema(counted.schema).parquet(path)
