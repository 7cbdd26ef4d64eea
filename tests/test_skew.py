"""A key that holds a third of all rows is split over tasks, and results stay whole."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rowloom.operators import change as M
from rowloom.operators import matching as X
from rowloom.operators import quality as Q
from rowloom.operators import shape as S
from rowloom.operators.keys import first_per_key, number_rows
from rowloom.operators.lookup import lookup

# small thresholds, so that the local tables count as large
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def lines(spark):
    """Line items of sf0.01, a third of them on one order. Many small map outputs, as a
    cluster would have: a partition is split between map outputs."""
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").repartition(16)
    return df.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))


def _final_plan(df):
    rows = df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue(), rows


def test_lookup_splits_the_hot_key(spark, large, lines):
    orders = lines.select("k").distinct().withColumn("name", F.concat(F.lit("o"), "k"))
    plan, rows = _final_plan(lookup(lines, orders, {"k": "k"}, order_by=["name"]).accepted)
    assert "skew=true" in plan
    assert len(rows) == 60000 and all(r.lkp1_name == f"o{r.k}" for r in rows)


def test_update_splits_a_hot_key_of_the_target(spark, large, lines):
    target = lines.select("k", "l_returnflag", "l_extendedprice", "l_shipdate")
    source = target.select("k").distinct().select(
        "k", F.lit("Z").alias("l_returnflag"), F.lit(1.0).alias("l_extendedprice"), F.lit(None).cast("timestamp_ntz").alias("l_shipdate")
    )
    plan, rows = _final_plan(M.update(target, source, ["k"]))
    assert "skew=true" in plan
    assert len(rows) == 60000 and all(r.l_returnflag == "Z" for r in rows)


def test_upsert_deals_out_a_hot_key_of_the_target(spark, large, lines):
    target = lines.select("k", F.col("l_partkey").alias("v"))
    source = target.select("k").distinct().filter("k % 2 = 0").select("k", F.lit(-1).cast("bigint").alias("v"))
    source = source.unionByName(spark.range(10**9, 10**9 + 500).select(F.col("id").alias("k"), F.lit(-2).cast("bigint").alias("v")))
    merged = M.upsert(target, source, ["k"])
    plan, rows = _final_plan(merged)
    final = plan.split("Initial Plan")[0]
    assert final.count("FullOuter") == 1 and final.count("Exchange hashpartitioning") == 2  # each side moves once
    assert len(rows) == 60500 and all(r.v == -2 if r.k >= 10**9 else (r.v == -1) == (r.k % 2 == 0) for r in rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    met = M._Changes(source, ["k"])._met(target)
    dealt = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(dealt) < 60500 / 5  # a third of the rows has one key


def test_first_and_diff_send_little_per_task(spark, large, lines):
    newest = first_per_key(lines, ["k"], [F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_linenumber"])
    assert newest.count() == lines.select("k").distinct().count()
    rows = Q.diff_rows(lines.select("k", "l_partkey"), lines.select("k", "l_partkey"), ["k"])
    assert rows.filter("state <> 'matched'").count() == 0
    assert rows.filter("k = 0").first().source_rows > 19000


def test_hot_group_is_numbered_in_ranges(spark, large, lines):
    numbered = number_rows(lines.select("k", "l_partkey", "l_suppkey"), "n", ["l_partkey", "l_suppkey"], ["k"], hot_rows=5000)
    hot = numbered.filter("k = 0").agg(F.count("n"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert hot[0] == hot[1] == hot[3] > 19000 and hot[2] == 1
    assert numbered.count() == 60000


def test_standardize_and_fuzzy_lookup_keep_hot_values(spark, large, lines):
    rest = [c for c in lines.columns if c != "k"]
    df = lines.select(*rest, F.when(F.col("k") == 0, "hot value").otherwise(F.concat(F.lit("v"), F.col("l_partkey").cast("string"))).alias("v"))
    reference = spark.createDataFrame([("HOT VALUE", "Hot")], "variant string, standard string")
    hot = df.filter("v = 'hot value'").count()
    plan, rows = _final_plan(S.standardize(df, "v", reference, "variant", "standard"))
    assert "skew=true" in plan and sum(r.v == "Hot" for r in rows) == hot
    plan, rows = _final_plan(X.fuzzy_lookup(df, spark.createDataFrame([("hot valu",)], "n string"), "v", "n", 1))
    assert "skew=true" in plan and len(rows) == 60000
    assert sum(r.match_value is not None for r in rows) == hot


def test_star_step_splits_the_centre(spark, large):
    # a third of all edges meet in one node
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").repartition(16)
    lines = lines.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    edges = lines.select(F.col("k").alias("v"), (F.col("l_partkey") * 1000 + F.col("l_suppkey") + 100000).alias("u")).distinct()
    plan, rows = _final_plan(X._large_star(edges))
    assert "skew=true" in plan and len(rows) > 0
