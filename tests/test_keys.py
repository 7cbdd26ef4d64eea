import pytest
from pyspark.sql import functions as F

from rowloom.operators.keys import first_per_key, number_rows, rank_equals, surrogate_key


def test_numbers_are_consecutive_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"))
    got = {r.k: r.n for r in number_rows(df, "n", ["k"]).collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_descending_order_and_start(spark):
    df = spark.range(0, 50, 1, 3)
    got = {r.id: r.n for r in number_rows(df, "n", [F.desc("id")], start=100).collect()}
    assert got == {i: 100 + 49 - i for i in range(50)}


def test_without_order_every_number_once_and_no_exchange_of_rows(spark):
    df = spark.range(0, 500, 1, 5)
    assert sorted(r.n for r in number_rows(df, "n").collect()) == list(range(1, 501))


@pytest.mark.parametrize("hot_rows", [1, 500, 10**6])
def test_hot_group_and_copies(spark, hot_rows):
    # one group holds most rows, many of them exact copies, and there is a null group
    df = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") % 5).alias("v"),
    )
    numbered = number_rows(df, "n", ["v"], ["g"], hot_rows=hot_rows)
    for group, items in _by_group(numbered).items():
        assert sorted(n for _, n in items) == list(range(1, len(items) + 1)), group
        assert [v for v, _ in sorted(items, key=lambda i: i[1])] == sorted(v for v, _ in items), group
    assert numbered.count() == 6000


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("g"), F.col("id"))
    ranged = df.repartitionByRange(8, "g", "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(ranged) == 8 and max(r["count"] for r in ranged) < 20000 / 3


def _by_group(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append((r.v, r.n))
    return groups


def test_surrogate_continues_and_steps(spark, rows):
    old = spark.createDataFrame([(7,), (9,)], "sk bigint")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    assert rows(surrogate_key(new, "sk", ["name"], existing=old)) == [("a", 10), ("b", 11)]
    assert rows(surrogate_key(new, "sk", ["name"], existing=old.limit(0))) == [("a", 1), ("b", 2)]
    assert rows(surrogate_key(new, "sk", ["name"], existing=old, step=10)) == [("a", 10), ("b", 20)]


def test_picking_needs_an_order(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert rows(first_per_key(df, ["k"], ["v"])) == [(1, "a"), (2, "c")]
    assert rows(rank_equals(df, ["k"], ["v"], 2)) == [(1, "b")]
    with pytest.raises(ValueError):
        first_per_key(df, ["k"], [])
    with pytest.raises(ValueError):
        number_rows(df, "n", group_by=["k"])
