"""Grouping, windows, sorting and set operations on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators import aggregate as A
from rowloom.plans.registry import Tables, query

LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
_LINE_ORDER_SQL = ", ".join(LINE_ORDER)


@query("agg_revenue", """
SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, min(l_shipdate) AS first_ship,
       max(l_shipdate) AS last_ship, count(DISTINCT l_suppkey) AS suppliers, round(avg(l_discount), 6) AS discount
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_revenue(t: Tables) -> DataFrame:
    exact = F.col("l_quantity").cast("decimal(18,2)"), F.col("l_extendedprice").cast("decimal(18,2)")
    grouped = A.aggregate(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "lines": ("count", "*"), "quantity": ("sum", exact[0]), "revenue": ("sum", exact[1]),
            "first_ship": ("min", "l_shipdate"), "last_ship": ("max", "l_shipdate"),
            "suppliers": ("count_distinct", "l_suppkey"), "discount": ("avg", "l_discount"),
        },
    )
    return grouped.withColumns(
        {"quantity": F.col("quantity").cast("double"), "revenue": F.col("revenue").cast("double"), "discount": F.round("discount", 6)}
    )


@query("distinct_types", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_types(t: Tables) -> DataFrame:
    return A.distinct_rows(t.part, ["p_brand", "p_type"])


@query("unique_rows", f"""
SELECT l_orderkey, l_linenumber, {_LINE_ORDER_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1
""")
def unique_rows(t: Tables) -> DataFrame:
    return A.first_per_key(t.lineitem.select("l_orderkey", "l_linenumber", *LINE_ORDER), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("duplicate_rows", f"""
SELECT l_orderkey, l_linenumber, {_LINE_ORDER_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn > 1
""")
def duplicate_rows(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", *LINE_ORDER)
    return A.unique_flows(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER).rejected


@query("value_count", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def value_count(t: Tables) -> DataFrame:
    return A.value_counts(t.part, "p_type", "n")


@query("denormalize_list", """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ';' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey
""")
def denormalize_list(t: Tables) -> DataFrame:
    # an order has a handful of lines, so its list is short whatever the table's size
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return A.joined_list(lines, ["l_orderkey"], "l_partkey", "parts", ";", order_by="l_linenumber")


@query("listagg_types", """
SELECT p_brand, string_agg(p_type, ',' ORDER BY p_type) AS types FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand
""")
def listagg_types(t: Tables) -> DataFrame:
    return A.joined_list(t.part, ["p_brand"], "p_type", "types", distinct=True)


@query("pivot_events", """
SELECT user_id, count(*) FILTER (event_type = 'click') AS click_n, count(*) FILTER (event_type = 'view') AS view_n,
       count(*) FILTER (event_type = 'purchase') AS purchase_n, max(ts) FILTER (event_type = 'click') AS click_last,
       max(ts) FILTER (event_type = 'view') AS view_last, max(ts) FILTER (event_type = 'purchase') AS purchase_last
FROM events GROUP BY user_id
""")
def pivot_events(t: Tables) -> DataFrame:
    kinds = ["click", "view", "purchase"]
    wide = A.rows_to_columns(t.events, ["user_id"], "event_type", kinds, {"n": F.count(F.lit(1)), "last": F.max("ts")})
    return wide.na.fill(0, [f"{k}_n" for k in kinds])


@query("max_watermark", "SELECT max(o_orderdate) AS max_o_orderdate FROM orders")
def max_watermark(t: Tables) -> DataFrame:
    return A.highest(t.orders, "o_orderdate")


_PROFILE = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("profile_nulls", " UNION ALL ".join(
    f"SELECT count(*) AS row_count, '{c}' AS column_name, count(*) - count({c}) AS null_count "
    "FROM (SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer)"
    for c in _PROFILE
))
def profile_nulls(t: Tables) -> DataFrame:
    df = t.customer.select(
        "c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END").alias("c_acctbal"), "c_mktsegment",
    )
    return A.profile(df)


@query("flow_meter", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def flow_meter(t: Tables) -> DataFrame:
    metered, _ = A.metered(t.orders, "orders_in", newest=F.max("o_orderdate"))
    return metered.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("qualify_latest", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def qualify_latest(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return A.rank_equals(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 1)


@query("qualify_third", """
SELECT o_orderkey, o_custkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 3
""")
def qualify_third(t: Tables) -> DataFrame:
    return A.rank_equals(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3)


@query("top_per_group", """
SELECT p_brand, p_partkey, p_retailprice, rn AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 5
""")
def top_per_group(t: Tables) -> DataFrame:
    top = A.top_per_key(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 5, "place")
    return top.withColumn("place", F.col("place").cast("bigint"))


@query("rownum_col", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rownum FROM orders
""")
def rownum_col(t: Tables) -> DataFrame:
    return A.row_position(t.orders.select("o_orderkey", "o_totalprice"), "rownum", [F.desc("o_totalprice"), "o_orderkey"])


@query("sort_in_group", """
SELECT event_type, event_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place FROM events
""")
def sort_in_group(t: Tables) -> DataFrame:
    return A.sort_within_groups(t.events.select("event_type", "event_id", "ts"), ["event_type"], ["ts", "event_id"], "place")


@query("window_events", """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS n, max(value) AS top FROM events GROUP BY ALL
""")
def window_events(t: Tables) -> DataFrame:
    return A.windowed_counts(t.events, "ts", "1 hour", None, {"n": F.count(F.lit(1)), "top": F.max("value")}, ["event_type"])


@query("window_sliding", """
SELECT time_bucket(INTERVAL '6 hours', ts) - INTERVAL (k * 6) HOUR AS window_start,
       time_bucket(INTERVAL '6 hours', ts) - INTERVAL (k * 6) HOUR + INTERVAL '1 day' AS window_end, count(*) AS n
FROM events, (SELECT unnest([0, 1, 2, 3]) AS k) GROUP BY ALL
""")
def window_sliding(t: Tables) -> DataFrame:
    return A.windowed_counts(t.events, "ts", "1 day", "6 hours", {"n": F.count(F.lit(1))})


@query("sort_rows", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def sort_rows(t: Tables) -> DataFrame:
    return A.sort_rows(t.customer.select("c_custkey", "c_acctbal"), [F.desc_nulls_last("c_acctbal"), "c_custkey"])


@query("topk_price", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk_price(t: Tables) -> DataFrame:
    return A.top_rows(t.orders.select("o_orderkey", "o_totalprice"), 100, [F.desc("o_totalprice"), "o_orderkey"])


@query("limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 200")
def limit_offset(t: Tables) -> DataFrame:
    return A.page_rows(t.orders.select("o_orderkey", "o_totalprice"), 200, 50, [F.desc("o_totalprice"), "o_orderkey"])


@query("random_n")
def random_n(t: Tables) -> DataFrame:
    return A.random_rows(t.customer, 50)


@query("union_by_name", """
SELECT c_custkey AS party_key, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return A.unite(customers, t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("party_key")))


@query("minus_keys", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def minus_keys(t: Tables) -> DataFrame:
    return A.difference(t.customer.select("c_custkey"), t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("minus_all", """
SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer
""")
def minus_all(t: Tables) -> DataFrame:
    return A.difference(t.orders.select("o_custkey"), t.customer.select("c_custkey"), keep_repeats=True)
