import pytest
from pyspark.sql import functions as F

from rowloom.operators import quality as Q

PEOPLE = "id bigint, name string, amount double, status string"
SOURCE = [(1, "Alice", 100.0, "ACTIVE"), (2, "Bob", 200.5, "ACTIVE"), (3, "Charlie", 300.0, "INACTIVE"),
          (4, "Diana", 150.75, "ACTIVE"), (5, "Eve", 500.0, "INACTIVE")]
CHANGED = [SOURCE[0], SOURCE[1], (3, "CHANGED", 999.99, "INACTIVE"), SOURCE[3], (6, "Frank", 600.0, "ACTIVE")]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(SOURCE, PEOPLE)


def test_equal_tables(people):
    summary, _ = Q.data_diff(people, people, ["id"])
    r = summary.first()
    assert (r.matched, r.mismatched, r.missing, r.extra, r.match_rate_pct, r.passed) == (5, 0, 0, 0, 100.0, True)


def test_different_tables(spark, people, rows):
    summary, detail = Q.data_diff(people, spark.createDataFrame(CHANGED, PEOPLE), ["id"], entity="people")
    r = summary.first()
    assert (r.matched, r.mismatched, r.missing, r.extra, r.match_rate_pct, r.passed) == (3, 1, 1, 1, 60.0, False)
    assert r.sample_mismatched == ['{"id":3}'] and r.sample_missing == ['{"id":5}']
    assert rows(detail.filter("state <> 'matched'"), "id", "state") == [(3, "mismatched"), (5, "missing"), (6, "extra")]


def test_extra_rows_alone_pass(spark, people):
    more = spark.createDataFrame([*SOURCE, CHANGED[-1]], PEOPLE)
    assert Q.data_diff(people, more, ["id"])[0].first().passed


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id bigint, val string")
    r = Q.data_diff(empty, empty, ["id"])[0].first()
    assert (r.matched, r.match_rate_pct, r.passed) == (0, 0.0, True)


def test_sample_restricts_both_sides(spark):
    df = spark.range(500).select("id", F.rand(42).alias("value"))
    r = Q.data_diff(df, df, ["id"], sample=100)[0].first()
    assert (r.source_rows, r.target_rows, r.matched) == (100, 100, 100)


def test_repeated_keys_and_nulls(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "n")], "id int, v string")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "NULL"), (None, "n")], "id int, v string")
    assert rows(Q.diff_rows(a, b, ["id"]), "id", "state") == [(1, "matched"), (2, "mismatched"), (None, "matched")]


def test_row_counts(spark, rows):
    cases = spark.createDataFrame(
        [("customers", 1000, 1000, 0.0), ("orders", 1000, 1005, 1.0), ("products", 1000, 900, 1.0), ("empty_table", 0, 0, 0.0),
         ("b", 200, 210, 10.0), ("new", 0, 5, 0.0), ("unknown", None, 5, 0.0)],
        Q.COUNT_SCHEMA,
    )
    got = {r.entity: (r.difference, r.difference_pct, r.passed) for r in Q.compare_counts(cases).collect()}
    assert got == {
        "customers": (0, 0.0, True), "orders": (5, 0.5, True), "products": (-100, -10.0, False), "empty_table": (0, 0.0, True),
        "b": (10, 5.0, True), "new": (5, 0.0, True), "unknown": (None, None, False),
    }
    strict = {r.entity: r.passed for r in Q.compare_counts(cases, strict_zero=True).collect()}
    assert strict["new"] is False and strict["empty_table"] is True


def _schemas(spark, expected, actual):
    side = [Q.schema_rows(spark, [{"name": n, "type": t} for n, t in cols]) for cols in (expected, actual)]
    return Q.schema_verdict(Q.compare_schemas(*side), "e").first()


def test_schemas(spark):
    base = [("id", "INTEGER"), ("email", "VARCHAR")]
    assert _schemas(spark, base, base).passed
    missing = _schemas(spark, base, base[:1])
    assert not missing.passed and missing.missing_columns == ["email"]
    extra = _schemas(spark, base, [*base, ("age", "INTEGER")])
    assert extra.passed and extra.extra_columns == ["age"]
    wrong = _schemas(spark, base, [("ID", "integer"), ("email", "NUMERIC")])
    assert not wrong.passed and wrong.type_mismatches == ["email"] and wrong.missing_columns == []


def test_rules_and_flows(spark, rows):
    df = spark.createDataFrame([(1, "a@b"), (None, "x"), (3, None)], "id int, mail string")
    flows = Q.check_rules(df, {"id": F.col("id").isNotNull(), "mail": "mail like '%@%'"})
    assert rows(flows.accepted) == [(1, "a@b")]
    assert rows(flows.rejected, "mail", "reasons") == [("x", ["id", "mail"]), (None, ["mail"])]
    flows = Q.not_null_flows(df, ["id", "mail"])
    assert flows.accepted.count() == 1 and flows.rejected.count() == 2


def test_compliance(spark, rows):
    df = spark.createDataFrame([("1", "ab"), ("x", "abc"), (None, None)], "n string, t string")
    spec = [{"name": "n", "type": "int", "nullable": False}, {"name": "t", "length": 2, "pattern": "^a"}]
    got = rows(Q.schema_compliance(df, spec).rejected, "n", "reasons")
    assert got == [("x", ["n:type", "t:length"]), (None, ["n:null"])]


def test_assertions(spark):
    df = spark.range(5)
    assert Q.assert_rows(df, "id >= 0", "negative").count() == 5
    with pytest.raises(Exception, match="too large"):
        Q.assert_rows(df, "id < 3", "too large").collect()
    Q.assert_aggregate(df, F.count(F.lit(1)) == 5, "five")
    with pytest.raises(AssertionError):
        Q.assert_aggregate(df, F.max("id") > 10, "ten")


def test_report(spark, people, tmp_path):
    Q.report(Q.data_diff(people, people, ["id"])[0], str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().passed


def test_compare_files(spark, tmp_path, rows):
    for side, items in {"l": {"a": "1", "b": "2", "c": "3"}, "r": {"a": "1", "b": "x", "d": "4"}}.items():
        (tmp_path / side).mkdir()
        for name, text in items.items():
            (tmp_path / side / name).write_text(text)
    got = rows(Q.compare_files(spark, str(tmp_path / "l"), str(tmp_path / "r")))
    assert got == [("a", "same"), ("b", "different"), ("c", "left_only"), ("d", "right_only")]


def test_tree_diff_finds_what_the_full_diff_finds(spark, rows):
    base = spark.range(60_000).select((F.col("id") % 50_000).alias("id"), F.concat(F.lit("v"), "id").alias("v"), F.lit("x").alias("my col"))
    kinds = "id bigint, v string, `my col` string"
    base = base.unionByName(spark.createDataFrame([(None, "n", "x"), (None, None, "x")], kinds))
    copy = base.filter("id IS NULL OR id NOT IN (17, 40017)").withColumn("v", F.when(F.col("id").isin(5, 20_005), "other").otherwise(F.col("v")))
    copy = copy.unionByName(spark.createDataFrame([(99_999, "new", "x"), (None, "n", "x")], kinds))
    full = Q.diff_rows(base, copy, ["id"]).filter("state <> 'matched'")
    for bits, leaf in ((10, 64), (4, 8), (3, 1), (10, 10**6)):
        found = Q.diff_tree(base, copy, ["id"], bits=bits, leaf_rows=leaf)
        assert rows(found.rows) == rows(full) and (found.source_rows, found.target_rows) == (base.count(), copy.count())
    # five ranges of hundreds of rows at most are looked at row by row
    assert base.count() - Q.diff_tree(base, copy, ["id"]).agreeing_rows < 1000
    same = Q.diff_tree(base, base, ["id"])
    assert same.rows.count() == 0 and same.agreeing_rows == base.count()
    none = Q.diff_tree(base.limit(0), base.limit(0), ["id"])
    assert none.rows.count() == 0 and Q.tree_summary(none, "e", ["id"]).first().passed
    single = base.filter("id IS NOT NULL AND id >= 10000"), copy.filter("id IS NOT NULL AND id >= 10000")
    assert rows(Q.tree_summary(Q.diff_tree(*single, ["id"]), "e", ["id"])) == rows(Q.diff_summary(Q.diff_rows(*single, ["id"]), "e", ["id"]))
