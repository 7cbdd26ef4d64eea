"""Change application on the driver tables.

The target holds the orders up to a load date; the source holds the orders of the last
loaded year, with corrected prices and states, and all later ones.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom import constants as C
from rowloom.operators import change as M
from rowloom.operators import incremental as I
from rowloom.operators.history import classify, load_history, read_history, scd2
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path

NOW = dt.datetime(2026, 1, 1, 6, 30)
LOADED_TO = "2000-01-01 00:00:00"
CHANGED_FROM = "1999-01-01 00:00:00"

_T = f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_TO}')"
_S = f"""(SELECT o_orderkey, o_custkey, 'C' AS o_orderstatus, o_totalprice + 1000 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_FROM}')"""
_CTE = f"WITH t AS {_T}, s AS {_S} "
_T_WITHOUT_S = "SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"
_MATCHED_S = "SELECT s.* FROM s WHERE o_orderkey IN (SELECT o_orderkey FROM t)"
KEYS = ["o_orderkey"]


def _target(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderdate") < F.lit(LOADED_TO).cast("timestamp_ntz"))


def _source(t: Tables) -> DataFrame:
    changed = t.orders.filter(F.col("o_orderdate") >= F.lit(CHANGED_FROM).cast("timestamp_ntz"))
    return changed.withColumns({"o_orderstatus": F.lit("C"), "o_totalprice": F.col("o_totalprice") + 1000})


@query("merge_insert", _CTE + "SELECT * FROM t UNION ALL SELECT * FROM s")
def merge_insert(t: Tables) -> DataFrame:
    return M.apply_action(_target(t), _source(t), KEYS, "insert")


@query("merge_update", _CTE + f"{_T_WITHOUT_S} UNION ALL {_MATCHED_S}")
def merge_update(t: Tables) -> DataFrame:
    return M.apply_action(_target(t), _source(t), KEYS, "UPDATE")


@query("merge_upsert", _CTE + f"{_T_WITHOUT_S} UNION ALL SELECT * FROM s")
def merge_upsert(t: Tables) -> DataFrame:
    return M.apply_action(_target(t), _source(t), KEYS, "INSERT_OR_UPDATE")


@query("merge_delete", _CTE + _T_WITHOUT_S)
def merge_delete(t: Tables) -> DataFrame:
    return M.apply_action(_target(t), _source(t), KEYS, "DELETE")


@query("merge_delete_insert", _CTE + f"{_T_WITHOUT_S} UNION ALL SELECT * FROM s")
def merge_delete_insert(t: Tables) -> DataFrame:
    return M.apply_action(_target(t), _source(t), KEYS, "Delete_Insert")


@query("merge_first_load", _CTE + "SELECT * FROM s")
def merge_first_load(t: Tables) -> DataFrame:
    return M.apply_action(None, _source(t), KEYS, "UPSERT")


@query("merge_latest_change", """
WITH latest AS (SELECT o_custkey, o_orderstatus, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
SELECT c_custkey, coalesce(o_orderstatus, 'none') AS last_status, o_orderdate AS last_date
FROM customer LEFT JOIN latest ON o_custkey = c_custkey
""")
def merge_latest_change(t: Tables) -> DataFrame:
    """Many source rows per key, cut to the latest by a stated order."""
    target = t.customer.select(
        "c_custkey", F.lit("none").alias("last_status"), F.lit(None).cast("timestamp_ntz").alias("last_date")
    )
    source = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("last_status"),
        F.col("o_orderdate").alias("last_date"), "o_orderkey",
    )
    source = M.one_row_per_key(source, ["c_custkey"], [F.desc("last_date"), F.desc("o_orderkey")]).drop("o_orderkey")
    return M.apply_action(target, source, ["c_custkey"], "UPDATE")


@query("soft_delete", _CTE + f"{_T_WITHOUT_S} UNION ALL SELECT * FROM s WHERE o_orderpriority <> '5-LOW'")
def soft_delete(t: Tables) -> DataFrame:
    source = _source(t).withColumn("is_deleted", F.col("o_orderpriority") == "5-LOW")
    return M.apply_deletes(_target(t), source, KEYS, "is_deleted")


# customers as the dimension; the source is a later extract of them and of suppliers as new parties
_MOVED = "CASE WHEN c_acctbal < 0 THEN 'HOUSEHOLD' ELSE c_mktsegment END"
_NEW_KEY = 1_000_000_000_000
_SNAPSHOT = f"""(SELECT c_custkey, c_name, c_nationkey, {_MOVED} AS c_mktsegment FROM customer WHERE c_nationkey <> 24
UNION ALL SELECT s_suppkey + {_NEW_KEY}, s_name, s_nationkey, 'SUPPLIER' FROM supplier)"""


def _snapshot(t: Tables) -> DataFrame:
    kept = t.customer.filter("c_nationkey <> 24").select("c_custkey", "c_name", "c_nationkey", F.expr(_MOVED).alias("c_mktsegment"))
    parties = t.supplier.select(
        (F.col("s_suppkey") + _NEW_KEY).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return kept.unionByName(parties)


@query("scd1_customer", f"""
WITH s AS {_SNAPSHOT}
SELECT c.c_custkey, coalesce(s.c_name, c.c_name) AS c_name, coalesce(s.c_nationkey, c.c_nationkey) AS c_nationkey, c.c_acctbal,
       coalesce(s.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN s USING (c_custkey)
UNION ALL SELECT c_custkey, c_name, c_nationkey, NULL, c_mktsegment FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def scd1_customer(t: Tables) -> DataFrame:
    return M.scd1(t.customer, _snapshot(t), ["c_custkey"])


FIRST = dt.datetime(2025, 1, 1)
_HASH = "md5(c_name || '||' || c_nationkey::VARCHAR || '||' || c_mktsegment)"
_FIRST_STATE = f"""
d AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_HASH} AS _row_hash, TIMESTAMP '2025-01-01 00:00:00' AS effective_from,
  TIMESTAMP '9999-12-31 00:00:00' AS effective_to, true AS is_current, TIMESTAMP '2025-01-01 00:00:00' AS _etl_loaded_at,
  'first' AS _etl_source, row_number() OVER (ORDER BY c_custkey) AS sk_customer FROM customer)"""
_SECOND_STATE = f"""
s AS (SELECT *, {_HASH} AS _row_hash FROM {_SNAPSHOT}),
closed AS (SELECT d.* REPLACE (
    CASE WHEN s.c_custkey IS NULL OR s._row_hash <> d._row_hash THEN TIMESTAMP '2026-01-01 06:30:00' ELSE d.effective_to END AS effective_to,
    NOT (s.c_custkey IS NULL OR s._row_hash <> d._row_hash) AS is_current)
  FROM d LEFT JOIN s ON s.c_custkey = d.c_custkey),
opened AS (SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_mktsegment, s._row_hash, TIMESTAMP '2026-01-01 06:30:00' AS effective_from,
    TIMESTAMP '9999-12-31 00:00:00' AS effective_to, true AS is_current, TIMESTAMP '2026-01-01 06:30:00' AS _etl_loaded_at,
    'second' AS _etl_source, (SELECT max(sk_customer) FROM d) + row_number() OVER (ORDER BY s.c_custkey) AS sk_customer
  FROM s LEFT JOIN d ON s.c_custkey = d.c_custkey WHERE d.c_custkey IS NULL OR d._row_hash <> s._row_hash)"""
_SCD2 = {"key": "c_custkey", "surrogate": "sk_customer", "tracked": ["c_name", "c_nationkey", "c_mktsegment"]}


def _dimension(t: Tables) -> DataFrame:
    first = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return scd2(None, first, now=FIRST, source_name="first", **_SCD2)


@query("scd2_first_load", f"WITH {_FIRST_STATE} SELECT * FROM d")
def scd2_first_load(t: Tables) -> DataFrame:
    return _dimension(t)


@query("scd2_customer", f"WITH {_FIRST_STATE}, {_SECOND_STATE} SELECT * FROM closed UNION ALL SELECT * FROM opened")
def scd2_customer(t: Tables) -> DataFrame:
    return scd2(_dimension(t), _snapshot(t), now=NOW, source_name="second", **_SCD2)


@query("scd2_rerun", f"WITH {_FIRST_STATE}, {_SECOND_STATE} SELECT * FROM closed UNION ALL SELECT * FROM opened")
def scd2_rerun(t: Tables) -> DataFrame:
    """The same snapshot a second time changes nothing."""
    once = scd2(_dimension(t), _snapshot(t), now=NOW, source_name="second", **_SCD2)
    return scd2(once, _snapshot(t), now=dt.datetime(2026, 2, 1), source_name="third", **_SCD2)


@query("scd2_stored", f"WITH {_FIRST_STATE}, {_SECOND_STATE} SELECT * FROM closed UNION ALL SELECT * FROM opened")
def scd2_stored(t: Tables) -> DataFrame:
    """The same three loads into a stored history, whose closed versions stay as they are."""
    path = scratch_path(t.spark, "history")
    first = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    for rows, now, name in ((first, FIRST, "first"), (_snapshot(t), NOW, "second"), (_snapshot(t), dt.datetime(2026, 2, 1), "third")):
        load_history(t.spark, path, rows, now=now, source_name=name, **_SCD2)
    return read_history(t.spark, path)


@query("scd2_as_of", f"WITH {_FIRST_STATE} SELECT * FROM d")
def scd2_as_of(t: Tables) -> DataFrame:
    """A stored history as it was after its first load."""
    path = scratch_path(t.spark, "history")
    first = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    for rows, now, name in ((first, FIRST, "first"), (_snapshot(t), NOW, "second")):
        load_history(t.spark, path, rows, now=now, source_name=name, **_SCD2)
    return read_history(t.spark, path, 1)


@query("change_states", f"""
WITH s AS {_SNAPSHOT}
SELECT coalesce(s.c_custkey, c.c_custkey) AS c_custkey, CASE WHEN c.c_custkey IS NULL THEN 'new' WHEN s.c_custkey IS NULL THEN 'deleted'
  WHEN (c.c_name, c.c_nationkey, c.c_mktsegment) IS DISTINCT FROM (s.c_name, s.c_nationkey, s.c_mktsegment) THEN 'changed' ELSE 'unchanged' END AS state
FROM customer c FULL JOIN s ON s.c_custkey = c.c_custkey
""")
def change_states(t: Tables) -> DataFrame:
    found = classify(t.customer, _snapshot(t), ["c_custkey"], _SCD2["tracked"])
    return found.select(F.coalesce("new.c_custkey", "old.c_custkey").alias("c_custkey"), F.col("_state").alias("state"))


def _control(t: Tables) -> DataFrame:
    """Control table with the newest date of the target."""
    return _target(t).agg(F.max("o_orderdate").cast("string").alias("last_watermark")).select(
        F.lit("orders").alias("table_name"), "last_watermark", C.clock(FIRST).alias("updated_at")
    )


@query("cdc_watermark", f"""
WITH t AS {_T} SELECT * FROM t UNION ALL SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM t)
""")
def cdc_watermark(t: Tables) -> DataFrame:
    return I.watermark_load(t.orders, _target(t), _control(t), "orders", KEYS, "o_orderdate", NOW).target


@query("cdc_control", """
SELECT 'orders' AS table_name, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_watermark,
       TIMESTAMP '2026-01-01 06:30:00' AS updated_at FROM orders
""")
def cdc_control(t: Tables) -> DataFrame:
    return I.watermark_load(t.orders, _target(t), _control(t), "orders", KEYS, "o_orderdate", NOW).control


@query("cdc_overlap", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL '30 days' FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')
""")
def cdc_overlap(t: Tables) -> DataFrame:
    last = I.last_watermark(_control(t), "orders")
    return I.changes_since(t.orders, "o_orderdate", last, "30 days").select("o_orderkey", "o_orderdate")


@query("incremental_target_max", f"""
WITH t AS {_T}
SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS _etl_loaded_at, 'orders' AS _etl_source FROM t
UNION ALL SELECT *, TIMESTAMP '2026-01-01 06:30:00', 'orders' FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM t)
""")
def incremental_target_max(t: Tables) -> DataFrame:
    first = I.target_max_load(_target(t), None, KEYS, "o_orderdate", FIRST, "orders").target
    return I.target_max_load(t.orders, first, KEYS, "o_orderdate", NOW, "orders").target


@query("date_slice", f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_FROM}'")
def date_slice(t: Tables) -> DataFrame:
    rows, _ = I.date_slice(t.orders, "o_orderdate", CHANGED_FROM)
    return rows


@query("full_load", "SELECT * FROM orders")
def full_load(t: Tables) -> DataFrame:
    rows, _ = I.date_slice(t.orders, "o_orderdate", CHANGED_FROM, full=True)
    return rows
