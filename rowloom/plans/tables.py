"""Catalog tables: written, appended to, merged in place and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.lookup import lookup
from rowloom.plans.changes import _CTE, _T_WITHOUT_S, KEYS, _source, _target
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.sources import tables as TB


def _new_table(t: Tables, label: str) -> dict[str, str]:
    """A table name nobody else uses, with its files in the shared folder."""
    return {"name": f"{label}_{uuid.uuid4().hex[:12]}", "path": scratch_path(t.spark, label)}


@query("managed_table", "SELECT * FROM orders")
def managed_table(t: Tables) -> DataFrame:
    table = _new_table(t, "managed")
    TB.save_table(t.orders, table["name"], "overwrite", ["o_orderstatus"], path=table["path"])
    return TB.read_table(t.spark, table["name"])


@query("schema_evolution", """
SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def schema_evolution(t: Tables) -> DataFrame:
    """A later load brings a column the first one lacked."""
    table = _new_table(t, "evolving")
    TB.save_table(t.supplier.select("s_suppkey", "s_name"), table["name"], "overwrite", path=table["path"])
    TB.save_table(t.supplier.select("s_acctbal", "s_suppkey", "s_name"), table["name"], path=table["path"])
    return TB.read_table(t.spark, table["name"])


@query("schema_evolution_parts", """
SELECT o_orderkey, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_totalprice, NULL, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1
""")
def schema_evolution_parts(t: Tables) -> DataFrame:
    """A partitioned table; the second load has a new column and lacks an old one, its keys are narrower."""
    table = _new_table(t, "evolving")
    first = t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    second = t.orders.filter("o_orderkey % 2 = 1").select("o_orderstatus", "o_totalprice", F.col("o_orderkey").cast("int").alias("O_ORDERKEY"))
    TB.save_table(first, table["name"], "overwrite", ["o_orderstatus"], path=table["path"])
    TB.save_table(second, table["name"], "append", ["o_orderstatus"])
    return TB.read_table(t.spark, table["name"])


@query("append_by_load_type", """
SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey > 1
""")
def append_by_load_type(t: Tables) -> DataFrame:
    """A full load replaces the table, the next load appends."""
    table = _new_table(t, "loads")
    for df, full in ((t.nation.filter("n_regionkey = 0"), True), (t.nation, True), (t.nation.filter("n_regionkey > 1"), False)):
        TB.save_by_load_type(df, table["name"], full, path=table["path"])
    return TB.read_table(t.spark, table["name"])


@query("partition_overwrite", """
SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
""")
def partition_overwrite(t: Tables) -> DataFrame:
    """A slice loaded again, twice, replaces its own partition only."""
    table = _new_table(t, "slices")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    TB.save_table(orders, table["name"], "overwrite", ["o_orderstatus"], path=table["path"])
    again = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        TB.insert_into(again, table["name"], overwrite_partitions=True)
    return TB.read_table(t.spark, table["name"])


@query("insert_statement", """
SELECT c_custkey AS party_key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 1000
""")
def insert_statement(t: Tables) -> DataFrame:
    table = _new_table(t, "parties")
    TB.save_table(t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name")), table["name"], "overwrite", path=table["path"])
    TB.run_statement(
        t.spark, f"INSERT INTO {table['name']} SELECT s_suppkey, s_name FROM new_parties WHERE s_acctbal > :least", {"least": 1000},
        new_parties=t.supplier,
    )
    return TB.read_table(t.spark, table["name"])


@query("merge_into_table", _CTE + f"{_T_WITHOUT_S} UNION ALL SELECT * FROM s")
def merge_into_table(t: Tables) -> DataFrame:
    table = _new_table(t, "merged")
    TB.merge_table(t.spark, table["name"], _target(t), KEYS, path=table["path"])
    TB.merge_table(t.spark, table["name"], _source(t), KEYS)
    return TB.read_table(t.spark, table["name"])


@query("merge_into_partitions", _CTE + f"{_T_WITHOUT_S} UNION ALL SELECT * FROM s")
def merge_into_partitions(t: Tables) -> DataFrame:
    """The target is partitioned by priority; the changes come in two parts, so each merge
    rewrites some partitions only."""
    table = _new_table(t, "parts")
    TB.merge_table(t.spark, table["name"], _target(t), KEYS, partition_by="o_orderpriority", path=table["path"])
    for part in ("o_orderpriority < '3'", "o_orderpriority >= '3'"):
        TB.merge_table(t.spark, table["name"], _source(t).filter(part), KEYS, partition_by="o_orderpriority")
    return TB.read_table(t.spark, table["name"])


@query("bucketed_join", """
SELECT o_orderkey, o_orderdate, count(*) AS lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate
""")
def bucketed_join(t: Tables) -> DataFrame:
    """Both tables bucketed on the order key, so join and grouping need no exchange."""
    orders, lines = _new_table(t, "orders_b"), _new_table(t, "lines_b")
    n = TB.bucket_count(t.orders, t.lineitem)
    for df, key, table in ((t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", orders), (t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey", lines)):
        # dealt out as Spark deals out buckets, so each bucket is one file
        TB.save_table(df.repartition(n, key), table["name"], "overwrite", bucket_by=(n, [key]), path=table["path"])
    joined = TB.read_table(t.spark, orders["name"]).join(TB.read_table(t.spark, lines["name"]), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderdate").agg(F.count(F.lit(1)).alias("lines"))


@query("inline_lookup", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS lkp1_word FROM orders
""")
def inline_lookup(t: Tables) -> DataFrame:
    """Orders against rows given inline."""
    words = TB.inline_rows(t.spark, [("O", "open"), ("F", "filled")], "code string, word string")
    return lookup(t.orders.select("o_orderkey", "o_orderstatus"), words, {"o_orderstatus": "code"}, order_by=["word"]).accepted.drop("o_orderstatus")
