"""Lookups and joins on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.flows import Flows
from rowloom.operators import lookup as L
from rowloom.operators.shape import map_columns
from rowloom.plans.registry import Tables, query
from rowloom.sources.tables import read_sql

SEGMENT = "BUILDING"


def enriched_flows(t: Tables) -> Flows:
    """Orders with the customer of one segment; the others are rejects."""
    customers = t.customer.filter(F.col("c_mktsegment") == SEGMENT)
    flows = L.lookup(t.orders, customers, {"o_custkey": "c_custkey"}, how="inner", order_by=["c_name"], prefix="lkp1_")
    enriched = map_columns(
        flows.accepted,
        {
            "order_id": "o_orderkey",
            "customer_name": "lkp1_c_name",
            "amount": "o_totalprice",
            "amount_with_tax": "amount_exact * tax_factor",
        },
        variables={"amount_exact": "cast(o_totalprice as decimal(18,2))", "tax_factor": "cast(1.2 as decimal(2,1))"},
        types={"amount_with_tax": "double"},
    )
    rejected = map_columns(flows.rejected, {"order_id": "o_orderkey", "customer_id": "o_custkey"})
    return Flows(enriched, rejected)


@query("enriched_orders", f"""
SELECT o_orderkey AS order_id, c_name AS customer_name, o_totalprice AS amount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.2 AS DECIMAL(2,1)) AS DOUBLE) AS amount_with_tax
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{SEGMENT}'
""")
def enriched_orders(t: Tables) -> DataFrame:
    return enriched_flows(t).accepted


@query("enriched_rejects", f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = '{SEGMENT}')
""")
def enriched_rejects(t: Tables) -> DataFrame:
    return enriched_flows(t).rejected


@query("lookup_left_first", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, c_custkey AS lkp1_c_custkey, c_name AS lkp1_c_name,
       c_acctbal AS lkp1_c_acctbal, c_mktsegment AS lkp1_c_mktsegment
FROM supplier LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer
) ON c_nationkey = s_nationkey AND rn = 1
""")
def lookup_left_first(t: Tables) -> DataFrame:
    return L.lookup(t.supplier, t.customer, {"s_nationkey": "c_nationkey"}, order_by=[F.desc("c_acctbal"), "c_custkey"]).accepted


@query("lookup_all_matches", """
SELECT o_orderkey, o_orderdate, l_linenumber AS lkp1_l_linenumber, l_partkey AS lkp1_l_partkey, l_quantity AS lkp1_l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def lookup_all_matches(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return L.lookup(orders, lines, {"o_orderkey": "l_orderkey"}, match="all").accepted


@query("lookup_chain", """
SELECT o_orderkey, o_custkey, c_nationkey AS lkp1_c_nationkey, n_regionkey AS lkp2_n_regionkey, n_name AS lkp2_n_name,
       r_name AS lkp3_r_name
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def lookup_chain(t: Tables) -> DataFrame:
    return L.lookup_chain(
        t.orders.select("o_orderkey", "o_custkey"),
        [
            L.Lookup(t.customer.select("c_custkey", "c_nationkey"), {"o_custkey": "c_custkey"}, ["c_nationkey"]),
            L.Lookup(t.nation, {"lkp1_c_nationkey": "n_nationkey"}, ["n_name"]),
            L.Lookup(t.region, {"lkp2_n_regionkey": "r_regionkey"}, ["r_name"]),
        ],
    )


@query("lookup_broadcast", """
SELECT c_custkey, c_name, c_nationkey, n_name AS nation_n_name FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def lookup_broadcast(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey")
    nations = t.nation.select("n_nationkey", "n_name")
    return L.lookup(
        customers, nations, {"c_nationkey": "n_nationkey"}, how="inner", order_by=["n_name"], prefix="nation_", broadcast=True
    ).accepted


def _supplier_lines(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"))


def _rich_suppliers(t: Tables) -> DataFrame:
    return t.supplier.filter("s_acctbal > 0").select("s_suppkey", "s_name")


def _join_sql(how: str) -> str:
    return f"""
SELECT s_suppkey, s_name, l_suppkey, lines
FROM (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0)
{how} JOIN (SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey"""


@query("join_inner", _join_sql("INNER"))
def join_inner(t: Tables) -> DataFrame:
    return L.equi_join(_rich_suppliers(t), _supplier_lines(t), {"s_suppkey": "l_suppkey"}, "inner")


@query("join_left", _join_sql("LEFT"))
def join_left(t: Tables) -> DataFrame:
    return L.equi_join(_rich_suppliers(t), _supplier_lines(t), {"s_suppkey": "l_suppkey"}, "left")


@query("join_right", _join_sql("RIGHT"))
def join_right(t: Tables) -> DataFrame:
    return L.equi_join(_rich_suppliers(t), _supplier_lines(t), {"s_suppkey": "l_suppkey"}, "right")


@query("join_full", _join_sql("FULL"))
def join_full(t: Tables) -> DataFrame:
    return L.equi_join(_rich_suppliers(t), _supplier_lines(t), {"s_suppkey": "l_suppkey"}, "full")


@query("join_semi", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def join_semi(t: Tables) -> DataFrame:
    keys = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return L.semi_by_keys(t.customer.select("c_custkey", "c_name"), keys, ["c_custkey"])


@query("hard_deletes", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def hard_deletes(t: Tables) -> DataFrame:
    """Orders whose key the line items lack."""
    present = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return L.missing_keys(t.orders.select("o_orderkey", "o_orderstatus"), present, ["o_orderkey"])


ELT = """
SELECT n_name AS nation, c_mktsegment AS segment, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
GROUP BY n_name, c_mktsegment"""


@query("elt_map", ELT)
def elt_map(t: Tables) -> DataFrame:
    spark_sql = ELT.replace("TIMESTAMP '1997-01-01 00:00:00'", "CAST(:since AS TIMESTAMP_NTZ)")
    return read_sql(
        t.spark, spark_sql, {"since": "1997-01-01 00:00:00"}, orders=t.orders, customer=t.customer, nation=t.nation
    )
