"""Validation and data quality on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators import quality as Q
from rowloom.plans.registry import Tables, query

# the copy under test: later orders missing, some states changed, suppliers' keys as extra rows
_EXTRA = 1_000_000_000_000
_COPY = f"""(SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
UNION ALL SELECT s_suppkey + {_EXTRA}, 0, 'N' FROM supplier)"""
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus"]


def _copy(t: Tables) -> DataFrame:
    kept = t.orders.filter("o_orderdate < timestamp_ntz'2001-01-01'").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") == "2-HIGH", "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    extra = t.supplier.select(
        (F.col("s_suppkey") + _EXTRA).alias("o_orderkey"), F.lit(0).cast("bigint").alias("o_custkey"), F.lit("N").alias("o_orderstatus")
    )
    return kept.unionByName(extra)


_STATE = f"""
SELECT coalesce(s.o_orderkey, c.o_orderkey) AS o_orderkey, CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows,
       CAST(c.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
       CASE WHEN c.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
            WHEN s.o_custkey = c.o_custkey AND s.o_orderstatus = c.o_orderstatus THEN 'matched' ELSE 'mismatched' END AS state
FROM orders s FULL JOIN {_COPY} c ON s.o_orderkey = c.o_orderkey"""


@query("data_diff_rows", _STATE)
def data_diff_rows(t: Tables) -> DataFrame:
    return Q.diff_rows(t.orders.select(*COLUMNS), _copy(t), ["o_orderkey"])


@query("data_diff", f"""
SELECT 'orders' AS entity, CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows,
       count(*) FILTER (state = 'matched') AS matched, count(*) FILTER (state = 'mismatched') AS mismatched,
       count(*) FILTER (state = 'missing') AS missing, count(*) FILTER (state = 'extra') AS extra, CAST(0 AS BIGINT) AS repeated_keys,
       round(count(*) FILTER (state = 'matched') / greatest(sum(source_rows), 1) * 100, 2) AS match_rate_pct, false AS passed
FROM ({_STATE})
""")
def data_diff(t: Tables) -> DataFrame:
    rows = Q.diff_rows(t.orders.select(*COLUMNS), _copy(t), ["o_orderkey"])
    return Q.diff_summary(rows, "orders", ["o_orderkey"], samples=0)


@query("data_diff_tree", f"SELECT * FROM ({_STATE}) WHERE state <> 'matched'")
def data_diff_tree(t: Tables) -> DataFrame:
    return Q.diff_tree(t.orders.select(*COLUMNS), _copy(t), ["o_orderkey"]).rows


_TOUCHED = "(SELECT * REPLACE (CASE WHEN o_orderkey % 5000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 7000 <> 5)"


@query("data_diff_tree_summary", f"""
SELECT 'orders' AS entity, count(*) AS source_rows, count(c.o_orderkey) AS target_rows,
  count(*) FILTER (s.o_totalprice = c.o_totalprice) AS matched, count(*) FILTER (s.o_totalprice <> c.o_totalprice) AS mismatched,
  count(*) FILTER (c.o_orderkey IS NULL) AS missing, CAST(0 AS BIGINT) AS extra, CAST(0 AS BIGINT) AS repeated_keys,
  round(count(*) FILTER (s.o_totalprice = c.o_totalprice) / greatest(count(*), 1) * 100, 2) AS match_rate_pct,
  count(*) FILTER (s.o_totalprice = c.o_totalprice) = count(*) AS passed
FROM orders s LEFT JOIN {_TOUCHED} c ON s.o_orderkey = c.o_orderkey
""")
def data_diff_tree_summary(t: Tables) -> DataFrame:
    """A copy with a few orders changed or lost."""
    price = F.when(F.col("o_orderkey") % 5000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = t.orders.filter("o_orderkey % 7000 <> 5").withColumn("o_totalprice", price)
    return Q.tree_summary(Q.diff_tree(t.orders, copy, ["o_orderkey"]), "orders", ["o_orderkey"], samples=0)


@query("data_diff_repeats", """
SELECT a.l_orderkey, a.n AS source_rows, coalesce(b.n, 0) AS target_rows,
       CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n = b.n THEN 'matched' ELSE 'mismatched' END AS state
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) a
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) b ON a.l_orderkey = b.l_orderkey
""")
def data_diff_repeats(t: Tables) -> DataFrame:
    """Keys with several rows are compared as bags."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    kept = t.lineitem.filter("l_returnflag <> 'R'").select("l_orderkey", "l_partkey", "l_linenumber")
    return Q.diff_rows(lines, kept, ["l_orderkey"])


@query("data_diff_sampled")
def data_diff_sampled(t: Tables) -> DataFrame:
    summary, _ = Q.data_diff(t.orders.select(*COLUMNS), _copy(t), ["o_orderkey"], entity="orders", sample=1000)
    return summary


@query("rowcount_compare", """
WITH c AS (
  SELECT 'orders' AS entity, (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01') AS t, 10.0 AS pct
  UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer WHERE c_acctbal >= 0), 1.0
  UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part), 0.0)
SELECT entity, s AS source_row_count, t AS target_row_count, CAST(pct AS DOUBLE) AS threshold_pct, t - s AS difference,
       round((t - s) / s * 100, 2) AS difference_pct, abs((t - s) / s * 100) <= pct AS passed FROM c
""")
def rowcount_compare(t: Tables) -> DataFrame:
    counts = Q.count_tables(
        {
            "orders": (t.orders, t.orders.filter("o_orderdate < timestamp_ntz'2001-01-01'"), 10.0),
            "customer": (t.customer, t.customer.filter("c_acctbal >= 0"), 1.0),
            "part": (t.part, t.part, 0.0),
        }
    )
    return Q.compare_counts(counts)


@query("schema_compare", """
SELECT * FROM (VALUES ('c_custkey', 'BIGINT', 'BIGINT', 'ok'), ('c_name', 'STRING', 'STRING', 'ok'), ('c_nationkey', 'BIGINT', 'INT', 'type_mismatch'),
  ('email', 'STRING', NULL, 'missing'), ('c_acctbal', NULL, 'DOUBLE', 'extra'), ('c_mktsegment', NULL, 'STRING', 'extra'))
AS v(column_name, expected_type, actual_type, state)
""")
def schema_compare(t: Tables) -> DataFrame:
    expected = [
        {"name": "C_CUSTKEY", "type": "bigint"}, {"name": "c_name", "type": "String"},
        {"name": "c_nationkey", "type": "bigint"}, {"name": "email", "type": "string"},
    ]
    return Q.compare_schemas(Q.schema_rows(t.spark, expected), Q.schema_rows(t.spark, t.customer.schema))


_NULLED = "(SELECT c_custkey, nullif(c_nationkey, 3) AS c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)"


def _nulled(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"), F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END").alias("c_acctbal")
    )


@query("not_null", f"SELECT * FROM {_NULLED} WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL")
def not_null(t: Tables) -> DataFrame:
    return Q.not_null_flows(_nulled(t), ["c_nationkey", "c_acctbal"]).accepted


@query("not_null_rejects", f"SELECT * FROM {_NULLED} WHERE c_nationkey IS NULL OR c_acctbal IS NULL")
def not_null_rejects(t: Tables) -> DataFrame:
    return Q.not_null_flows(_nulled(t), ["c_nationkey", "c_acctbal"]).rejected


@query("pattern_check", r"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]{3}-[0-9]{4}')")
def pattern_check(t: Tables) -> DataFrame:
    return Q.pattern_flows(t.documents, "text", "[0-9]{3}-[0-9]{4}").accepted.select("doc_id", "lang")


@query("pattern_check_rejects", r"SELECT doc_id, lang FROM documents WHERE NOT regexp_matches(text, '[0-9]{3}-[0-9]{4}')")
def pattern_check_rejects(t: Tables) -> DataFrame:
    return Q.pattern_flows(t.documents, "text", "[0-9]{3}-[0-9]{4}").rejected.select("doc_id", "lang")


SPEC = [
    {"name": "c_custkey", "type": "int", "nullable": False},
    {"name": "c_name", "length": 18, "pattern": "^Customer#[0-9]+$"},
    {"name": "c_nationkey", "type": "int", "nullable": False},
    {"name": "c_mktsegment", "values": ["BUILDING", "MACHINERY", "FURNITURE"], "length": 8},
]
_CHECKED = """(SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS c_nationkey, c_mktsegment,
  concat_ws(',', CASE WHEN nullif(c_nationkey, 3) IS NULL THEN 'c_nationkey:null' END,
    CASE WHEN length(c_mktsegment) > 8 THEN 'c_mktsegment:length' END,
    CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'c_mktsegment:values' END) AS reasons FROM customer)"""


def _compliance(t: Tables):
    df = t.customer.select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"), "c_mktsegment")
    return Q.schema_compliance(df, SPEC)


@query("schema_compliance", f"SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM {_CHECKED} WHERE reasons = ''")
def schema_compliance(t: Tables) -> DataFrame:
    return _compliance(t).accepted


@query("quarantine", f"SELECT c_custkey, c_name, c_nationkey, c_mktsegment, reasons FROM {_CHECKED} WHERE reasons <> ''")
def quarantine(t: Tables) -> DataFrame:
    return _compliance(t).rejected.withColumn("reasons", F.array_join("reasons", ","))


@query("rule_counts", """
SELECT 'large' AS rule, count(*) AS broken FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT 'discount', count(*) FROM lineitem WHERE l_discount > 0.09
""")
def rule_counts(t: Tables) -> DataFrame:
    flows = Q.check_rules(t.lineitem, {"large": "l_quantity <= 45", "discount": "l_discount <= 0.09"})
    return flows.rejected.select(F.explode("reasons").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("broken"))


@query("assert_rows", "SELECT o_orderkey, o_totalprice FROM orders")
def assert_rows(t: Tables) -> DataFrame:
    return Q.assert_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice >= 0", "negative price")


@query("unique_check", """
SELECT doc_id, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1
""")
def unique_check(t: Tables) -> DataFrame:
    """Documents whose whole text an earlier document has; keyed by a digest of the text."""
    keyed = t.documents.select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("digest"))
    return Q.unique_check(keyed, ["digest"], ["doc_id"]).rejected.drop("digest")
