"""Queries whose rows are what an operator did: files, measures, verdicts and modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators import aggregate as A
from rowloom.operators import incremental as I
from rowloom.operators import quality as Q
from rowloom.operators import shape as S
from rowloom.plans.changes import CHANGED_FROM
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.sources import files

_KINDS = ["click", "view", "purchase", "signup", "error"]


@query("pivot_all_events", "SELECT user_id, " + ", ".join(
    f"count(*) FILTER (event_type = '{k}') AS {k}_n, max(ts) FILTER (event_type = '{k}') AS {k}_last" for k in _KINDS
) + " FROM events GROUP BY user_id")
def pivot_all_events(t: Tables) -> DataFrame:
    """Every type of event as columns of the user."""
    wide = A.rows_to_columns(t.events, ["user_id"], "event_type", _KINDS, {"n": F.count(F.lit(1)), "last": F.max("ts")})
    return wide.na.fill(0, [f"{k}_n" for k in _KINDS])


@query("binary_files", """
SELECT c_mktsegment, CAST(sum(octet_length(encode(c_name)) + 1) AS BIGINT) AS bytes, count(*) AS lines FROM customer GROUP BY c_mktsegment
""")
def binary_files(t: Tables) -> DataFrame:
    """Text files that Spark wrote, read as bytes: their lengths, and the line ends in their contents."""
    path = scratch_path(t.spark, "texts")
    t.customer.select("c_name", "c_mktsegment").write.partitionBy("c_mktsegment").text(path)
    found = files.read_binary(t.spark, path, "*.txt")
    segment = F.regexp_extract(F.url_decode("path"), "c_mktsegment=([^/]+)/", 1).alias("c_mktsegment")
    ends = F.regexp_count(F.hex("content"), F.lit("(?:..)*?0A"))
    return found.groupBy(segment).agg(F.sum("length").alias("bytes"), F.sum(ends).cast("bigint").alias("lines"))


@query("metered_totals", "SELECT 'orders_in' AS flow, count(*) AS n, max(o_orderdate) AS newest FROM orders")
def metered_totals(t: Tables) -> DataFrame:
    """What a meter saw while another action read the rows."""
    flow, seen = A.metered(t.orders, "orders_in", newest=F.max("o_orderdate").cast("string"))
    flow.write.format("noop").mode("overwrite").save()
    found = seen.get
    rows = t.spark.createDataFrame([("orders_in", found["rows"], found["newest"])], "flow string, n bigint, newest string")
    return rows.withColumn("newest", F.col("newest").cast("timestamp_ntz"))


_RULES = {"price": "o_totalprice >= 0", "customer": "o_custkey IS NOT NULL", "early": "o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'", "state": "o_orderstatus IN ('O', 'F')"}


@query("assert_outcomes", " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({rule.replace('TIMESTAMP_NTZ', 'TIMESTAMP')}, false)) > 0 AS died FROM orders" for name, rule in _RULES.items()
))
def assert_outcomes(t: Tables) -> DataFrame:
    """Which rules end the job that reads the checked rows, and which let it pass."""
    outcomes = []
    for name, rule in _RULES.items():
        try:
            Q.assert_rows(t.orders, rule, f"rule {name} is broken").write.format("noop").mode("overwrite").save()
            outcomes.append((name, False))
        except Exception as error:
            if f"rule {name} is broken" not in str(error):
                raise
            outcomes.append((name, True))
    return t.spark.createDataFrame(outcomes, "rule string, died boolean")


@query("warn_outcomes", " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({rule.replace('TIMESTAMP_NTZ', 'TIMESTAMP')}, false)) AS broken FROM orders" for name, rule in _RULES.items()
))
def warn_outcomes(t: Tables) -> DataFrame:
    """Rules that only warn: one pass through all of them, and how many rows broke each."""
    checked, counts = t.orders, {}
    for name, rule in _RULES.items():
        checked, counts[name] = Q.warn_rows(checked, rule, name)
    checked.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([(name, broken()) for name, broken in counts.items()], "rule string, broken bigint")


@query("load_modes", f"""
SELECT 'overwrite' AS mode, count(*) AS n FROM orders UNION ALL SELECT 'append', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_FROM}'
""")
def load_modes(t: Tables) -> DataFrame:
    """The write mode that goes with a full load and with a slice, next to the rows of each."""
    parts = [I.date_slice(t.orders, "o_orderdate", CHANGED_FROM, full=full) for full in (True, False)]
    counted = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("mode"), "n") for rows, mode in parts]
    return counted[0].unionByName(counted[1])


@query("file_compare_states", """
SELECT DISTINCT o_orderpriority AS file, CASE o_orderpriority WHEN '1-URGENT' THEN 'left_only' WHEN '5-LOW' THEN 'right_only' WHEN '2-HIGH' THEN 'different' ELSE 'same' END AS state
FROM orders
""")
def file_compare_states(t: Tables) -> DataFrame:
    """Two exports of which one lacks a file on either side and one file differs."""
    paths = [scratch_path(t.spark, "export") for _ in range(2)]
    summary = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))
    summary.filter("o_orderpriority <> '5-LOW'").write.partitionBy("o_orderpriority").json(paths[0])
    changed = summary.withColumn("n", F.when(F.col("o_orderpriority") == "2-HIGH", F.col("n") + 1).otherwise(F.col("n")))
    changed.filter("o_orderpriority <> '1-URGENT'").write.partitionBy("o_orderpriority").json(paths[1])
    return Q.compare_files(t.spark, *paths, name=F.regexp_extract(F.url_decode("path"), "o_orderpriority=([^/]+)/", 1))


@query("report_read_back", """
SELECT c_nationkey, count(*) AS n, min(c_acctbal) AS least FROM customer GROUP BY c_nationkey
""")
def report_read_back(t: Tables) -> DataFrame:
    """A report written as JSON lines in two goes and read again."""
    path = scratch_path(t.spark, "report")
    results = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("least"))
    for part in ("c_nationkey < 10", "c_nationkey >= 10"):
        Q.report(results.filter(part), path)
    return t.spark.read.schema(results.schema).json(path)


@query("sample_verdicts", """
SELECT 'sample_rows' AS operator, least(1000, count(*)) AS n, true AS members, true AS repeatable FROM orders
UNION ALL SELECT 'random_rows', least(1000, count(*)), true, true FROM orders
""")
def sample_verdicts(t: Tables) -> DataFrame:
    """Samples of a stated size: how many distinct rows, whether all are of the table, and whether a second draw is alike."""
    keys = t.orders.select("o_orderkey")
    draws = {
        "sample_rows": lambda: S.sample_rows(t.orders, 1000, ["o_orderkey"], 5).select("o_orderkey"),
        "random_rows": lambda: A.random_rows(t.orders, 1000, 5).select("o_orderkey"),
    }
    verdicts = []
    for name, draw in draws.items():
        first, second = draw(), draw()
        found = first.join(keys, "o_orderkey", "left_semi").distinct().count()
        verdicts.append((name, first.count(), found == first.count(), first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()))
    return t.spark.createDataFrame(verdicts, "operator string, n bigint, members boolean, repeatable boolean")
