import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from rowloom.operators import aggregate as A
from rowloom.operators import rowcode as U
from rowloom.operators import shape as S


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a;b", 5.0), (2, None, None), (3, "", -1.0)], "id int, t string, x double")


def test_flows_add_up(df, rows):
    flows = S.filter_flows(df, "x > 0")
    assert rows(flows.accepted, "id") == [(1,)] and rows(flows.rejected, "id") == [(2,), (3,)]


def test_splits(df, rows):
    conditions = {"a": "id >= 1", "b": "id >= 2"}
    loose, strict = S.split_flows(df, conditions), S.split_flows(df, conditions, exclusive=True)
    assert loose["a"].count() == 3 and loose["b"].count() == 2
    assert strict["a"].count() == 3 and strict["b"].count() == 0


def test_outputs_and_rejects(df, rows):
    out = S.map_outputs(df, {"pos": ("y > 0", {"k": "id", "y": "y"})}, {"rest": {"k": "id"}}, {"y": "x * 2"})
    assert rows(out["pos"]) == [(1, 10.0)] and rows(out["rest"]) == [(2,), (3,)]


def test_unknown_names_are_ignored(df):
    assert S.rename(df, {"nope": "x", "id": "key"}).columns == ["key", "t", "x"]
    assert S.cast_columns(df, {"nope": "int"}).columns == df.columns
    assert S.fill_defaults(df, {"nope": 1}).columns == df.columns


def test_casts(spark, rows):
    df = spark.createDataFrame([("1",), ("x",)], "s string")
    assert rows(S.cast_columns(df, {"s": "int"})) == [(1,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.cast_columns(df, {"s": "int"}, strict=True).collect()


def test_defaults(df, rows):
    assert rows(S.fill_defaults(df, {"x": 0.0, "t": "?"}), "t", "x") == [("", -1.0), ("?", 0.0), ("a;b", 5.0)]
    assert rows(S.fill_defaults(df, {"t": "?"}, blank=True), "t") == [("?",), ("?",), ("a;b",)]


def test_split_to_rows(df, rows):
    assert rows(S.split_to_rows(df, "t", ";", "item"), "id", "item") == [(1, "a"), (1, "b"), (3, "")]
    assert (2, None) in rows(S.split_to_rows(df, "t", ";", "item", keep_null=True), "id", "item")
    odd = df.sparkSession.createDataFrame([("a.*b\\Ec",)], "t string")
    assert rows(S.split_to_rows(odd, "t", ".*")) == [("a",), ("b\\Ec",)]
    assert rows(S.split_to_rows(odd, "t", "\\E")) == [("a.*b",), ("c",)]


def test_delimited_and_regex_fields(spark, rows):
    df = spark.createDataFrame([("1|x",), ("oops",)], "s string")
    assert rows(S.delimited_fields(df, "s", "|", {"n": "int", "v": "string"}), "n", "v") == [(1, "x"), (None, None)]
    flows = S.regex_fields(df, "s", r"^(\d+)\|(.*)$", {"n": "int", "v": "string"})
    assert rows(flows.accepted, "n", "v") == [(1, "x")] and rows(flows.rejected) == [("oops",)]


def test_row_hash_collisions(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), (None, "x"), ("NULL", "x")], "p string, q string")
    assert df.select(S.row_hash(["p", "q"])).distinct().count() == 2
    assert df.select(S.row_hash(["p", "q"], safe=True)).distinct().count() == 4
    with pytest.raises(ValueError):
        S.row_hash(["p"], "crc")


def test_row_hash_value(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "z")], "a int, b string, c string")
    assert S.with_row_hash(df).first()["_row_hash"] == hashlib.md5(b"1||NULL||z").hexdigest()


def test_masks(spark):
    df = spark.createDataFrame([("Ab12",), ("x",), (None,)], "s string")
    got = df.select(S.mask("s", "tail", keep_last=2), S.mask("s", "chars")).collect()
    assert [tuple(r) for r in got] == [("**12", "Xxnn"), ("x", "x"), (None, None)]
    with pytest.raises(ValueError):
        S.mask("s", "rot13")


def test_audit_columns(df):
    got = S.audit_columns(df, "job", dt.datetime(2026, 1, 1, 5)).first()
    assert (got["_etl_loaded_at"], got["_etl_source"], got["_etl_run_date"]) == (dt.datetime(2026, 1, 1, 5), "job", dt.date(2026, 1, 1))


def test_samples_repeat(spark, rows):
    df = spark.range(1000)
    assert rows(S.sample_by_key(df, ["id"], 10)) == rows(S.sample_by_key(df.repartition(7), ["id"], 10))
    few = S.sample_rows(df, 25, ["id"])
    assert few.count() == 25 and rows(few) == rows(S.sample_rows(df.repartition(5), 25, ["id"]))
    # the bound leaves the same rows as ordering all of them
    want = df.orderBy(F.xxhash64(F.lit(42), "id"), "id").limit(25)
    assert rows(few) == rows(want)
    copies = df.withColumn("k", F.lit(1))
    assert S.sample_rows(copies, 300, ["k"]).count() == 300
    assert S.sample_rows(df, 5000, ["id"]).count() == 1000
    assert A.random_rows(df, 25).count() == 25 and A.random_rows(df, 5000).count() == 1000
    assert A.random_rows(df, 1).count() == 1


@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_unique_flows_are_the_input(spark, rows, hot_rows):
    df = spark.range(0, 900, 1, 6).selectExpr("if(id % 3 = 0, 0, id) as k", "id % 4 as v")
    flows = A.unique_flows(df, ["k"], ["v"], hot_rows=hot_rows)
    assert rows(flows.accepted.union(flows.rejected)) == rows(df)
    assert flows.accepted.count() == df.select("k").distinct().count()


def test_aggregate_and_meter(df):
    out = A.aggregate(df, [], {"n": ("count", "*"), "known": ("count", "x"), "s": ("sum", "x")}).first()
    assert tuple(out) == (3, 2, 4.0)
    with pytest.raises(ValueError):
        A.aggregate(df, [], {"n": ("mystery", "*")})
    metered, seen = A.metered(df, "m", top=F.max("x"))
    metered.collect()
    assert seen.get == {"rows": 3, "top": 5.0}


def test_profile(df, rows):
    assert rows(A.profile(df), "column_name", "null_count", "row_count") == [("id", 0, 3), ("t", 1, 3), ("x", 1, 3)]


def test_staged_code_per_partition(spark):
    import pandas as pd

    df = spark.range(0, 100, 1, 4)
    total = U.staged_code(
        df, lambda s, b: (s.append(len(b)), b.iloc[0:0].rename(columns={"id": "n"}))[1], "n bigint", list,
        lambda s: pd.DataFrame({"n": [sum(s)]}),
    )
    assert sorted(r.n for r in total.collect()) == [25] * 4


def test_replicate(df, rows):
    out = S.replicate(df, {"a": lambda d: d.filter("id = 1"), "b": lambda d: d.select("id")})
    assert out["a"].count() == 1 and out["b"].count() == 3


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_joined_list_of_a_hot_group(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(A, "_PIECE", 7)
    df = spark.range(0, 300, 1, 5).selectExpr("if(id % 3 = 0, 'hot', string(id)) as g", "299 - id as k", "id as v")
    got = {r.g: r.text for r in A.joined_list(df, ["g"], "v", "text", "|", order_by="k", hot_rows=hot_rows).collect()}
    assert got["hot"] == "|".join(str(i) for i in range(297, -1, -3)) and got["1"] == "1" and len(got) == 201


def test_joined_list_keeps_groups_of_nulls(spark):
    from rowloom.operators.aggregate import joined_list

    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "k string, v string")
    for hot_rows in (1_000_000, 1):
        assert {r.k: r.names for r in joined_list(df, ["k"], "v", "names", hot_rows=hot_rows).collect()} == {"a": "x", "b": None}


def test_types_beyond_spark_decimals_lose_no_digits():
    from rowloom.schema import spark_type

    assert spark_type("DECIMAL(65,30)", "mysql") == "string"
    assert spark_type("NUMBER(10,-2)", "oracle") == "decimal(12,0)"


def test_fan_out_reads_its_input_once(spark, rows, tmp_path):
    source = spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("m"))
    path = str(tmp_path / "in")
    source.write.parquet(path)
    flows = S.FanOut(spark.read.parquet(path), {
        "one": ("m = 1", {"id": F.col("id")}), "unset": (F.col("m").isNull(), {"id": F.col("id"), "why": F.lit("none")}), "never": ("m > 5", None), "all": (None, None),
    })
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        flows.rows.explain("formatted")
    assert text.getvalue().count("Scan parquet") == 2  # once in the tree, once in the details
    assert "InMemoryRelation" not in text.getvalue()
    out = flows.write(str(tmp_path / "out"))
    assert rows(out["one"]) == [(i,) for i in range(1, 100, 3)] and out["never"].count() == 0
    assert rows(out["unset"]) == [(i, "none") for i in range(0, 100, 3)] and out["all"].columns == ["id", "m"] and out["all"].count() == 100
    with pytest.raises(ValueError, match="several types"):
        S.FanOut(source, {"a": (None, {"x": F.lit(1)}), "b": (None, {"x": F.lit("s")})})
