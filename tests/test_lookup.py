import pytest

from rowloom.operators.lookup import Lookup, broadcast_if_small, equi_join, lookup, lookup_chain


@pytest.fixture
def main(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, code string")


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("a", 10), ("a", 5), ("b", 7), (None, 1)], "code string, v int")


def test_first_match_is_chosen_by_the_order(main, table, rows):
    flows = lookup(main, table, {"code": "code"}, order_by=["v"])
    assert rows(flows.accepted, "id", "lkp1_v") == [(1, 5), (2, 7), (3, None), (4, None)]
    assert rows(flows.rejected, "id") == [(3,), (4,)]


def test_inner_keeps_matches_and_rejects_the_rest(main, table, rows):
    flows = lookup(main, table, {"code": "code"}, how="inner", order_by=["v"])
    assert rows(flows.accepted, "id") == [(1,), (2,)]
    assert flows.accepted.count() + flows.rejected.count() == main.count()


def test_all_matches(main, table, rows):
    got = lookup(main, table, {"code": "code"}, match="all", prefix="x_").accepted
    assert rows(got, "id", "x_v") == [(1, 5), (1, 10), (2, 7), (3, None), (4, None)]


def test_chain_prefixes(main, table, spark, rows):
    names = spark.createDataFrame([(5, "five"), (7, "seven")], "v int, name string")
    got = lookup_chain(main, [Lookup(table, {"code": "code"}, ["v"]), Lookup(names, {"lkp1_v": "v"}, ["name"], how="inner")])
    assert rows(got, "id", "lkp2_name") == [(1, "five"), (2, "seven")]


def test_bad_options(main, table):
    for wrong in ({"how": "full"}, {"match": "last"}):
        with pytest.raises(ValueError):
            lookup(main, table, {"code": "code"}, order_by=["v"], **wrong)


def test_broadcast_only_below_the_limits(spark):
    df = spark.range(100)
    small, large = broadcast_if_small(df), broadcast_if_small(df, max_rows=10)
    assert "BroadcastExchange" in _plan(spark.range(5).join(small, "id").hint("x"))
    assert large is df
    wide = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    assert broadcast_if_small(wide, max_bytes=10_000) is wide


def _plan(df):
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_hot_key_on_both_sides_stays_whole(spark):
    # a third of the main rows share one key, the lookup has many rows for it
    main = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id) as k")
    table = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    flows = lookup(main, table, {"k": "k"}, order_by=["v"])
    assert flows.accepted.count() == 3000
    assert flows.accepted.filter("k = 0").select("lkp1_v").distinct().collect()[0][0] == 0


def test_full_join_keeps_both_sides(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "j int, r string")
    got = equi_join(left, right, {"k": "j"}, "full")
    assert rows(got) == rows(left.join(right, left.k == right.j, "full"))
