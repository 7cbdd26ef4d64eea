"""Caller's code on the driver tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators import rowcode as U
from rowloom.plans.registry import Tables, query


@query("row_code", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'HIGH' ELSE 'NORMAL' END AS status, upper(trim(o_orderpriority)) AS priority FROM orders
""")
def row_code(t: Tables) -> DataFrame:
    return U.row_code(
        t.orders,
        {"status": F.when(F.col("o_totalprice") > 300000, "HIGH").otherwise("NORMAL"), "priority": F.upper(F.trim("o_orderpriority"))},
    ).select("o_orderkey", "status", "priority")


@query("batch_code", "SELECT event_id, event_type, event_type || ':' || CAST(user_id AS VARCHAR) AS label FROM events")
def batch_code(t: Tables) -> DataFrame:
    def label(kind: pd.Series, user: pd.Series) -> pd.Series:
        return kind + ":" + user.astype("string")

    return U.batch_code(t.events, "label", label, ["event_type", "user_id"], "string").select("event_id", "event_type", "label")


@query("staged_code", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 10) AS high FROM events GROUP BY event_type")
def staged_code(t: Tables) -> DataFrame:
    """Start, main and end code keep a count per kind in each partition; Spark adds them up."""
    def count(state: dict, batch: pd.DataFrame) -> pd.DataFrame:
        for kind, rows in batch.groupby("event_type"):
            n, high = state.get(kind, (0, 0))
            state[kind] = (n + len(rows), high + int((rows["value"] > 10).sum()))
        return pd.DataFrame({"event_type": pd.Series(dtype=str), "n": pd.Series(dtype="int64"), "high": pd.Series(dtype="int64")})

    def totals(state: dict) -> pd.DataFrame:
        rows = [(kind, n, high) for kind, (n, high) in state.items()]
        return pd.DataFrame(rows, columns=["event_type", "n", "high"])

    parts = U.staged_code(t.events.select("event_type", "value"), count, "event_type string, n bigint, high bigint", dict, totals)
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("high").alias("high"))


@query("running_number", "SELECT event_id, upper(trim(event_type)) AS result, row_number() OVER (ORDER BY ts, event_id) AS seq FROM events")
def running_number(t: Tables) -> DataFrame:
    df = U.row_code(t.events, {"result": F.upper(F.trim("event_type"))})
    return U.running_number(df, "seq", ["ts", "event_id"]).select("event_id", "result", "seq")


@query("code_block", "SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY user_id")
def code_block(t: Tables) -> DataFrame:
    return U.code_block(t.events, lambda df: df.filter("event_type <> 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
