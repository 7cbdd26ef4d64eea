import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.plans import QUERIES
from rowloom.sources import connectors, files, jdbc
from rowloom.sources import tables as TB
from rowloom.streaming.sources import load_available, read_file_stream, topic_options
from rowloom.streaming.upsert import compact, stream_upsert, upsert_state


def test_jdbc_vendors_and_options():
    got = jdbc.connection("postgresql", "shop", "db", 5432, user="u", password="p")
    assert got == {"url": "jdbc:postgresql://db:5432/shop", "driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    assert len(jdbc.VENDORS) == 17
    with pytest.raises(ValueError):
        jdbc.connection("dbase", "x")


def test_jdbc_read_options():
    assert jdbc.read_options(table="t") == {"dbtable": "t"}
    split = jdbc.read_options(query="SELECT 1;", split_by="id", bounds=(1, 100), partitions=4)
    assert split == {"dbtable": "(SELECT 1) q", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4"}
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "split_by": "id"}):
        with pytest.raises(ValueError):
            jdbc.read_options(**wrong)


def test_jdbc_write_options():
    assert jdbc.write_options(connections=8)["numPartitions"] == "8"
    assert jdbc.write_options()["batchsize"] == "10000"
    assert jdbc.primary_columns([{"name": "a", "key": True}, {"name": "b"}]) == ["a"]


def test_connectors(spark, tmp_path):
    with pytest.raises(ValueError):
        connectors.read_source(spark, "floppy")
    with pytest.raises(ValueError, match="collection"):
        connectors.read_source(spark, "mongodb", {"connection.uri": "x", "database": "d"})
    with pytest.raises(connectors.MissingConnector):
        connectors.read_source(spark, "excel", path=str(tmp_path))
    with pytest.raises(connectors.MissingConnector):
        connectors.write_sink(spark.range(1), "delta", path=str(tmp_path / "x"))


def test_entries(spark, tmp_path):
    (tmp_path / "a.ldif").write_text("# comment\ndn: uid=1\nmail: a@x\nmail: b@x\nnote: long\n er text\n\ndn: uid=2\n\n")
    got = {r.dn[0]: r for r in files.read_entries(spark, str(tmp_path), ["dn", "mail", "note"]).collect()}
    assert got["uid=1"].mail == ["a@x", "b@x"] and got["uid=1"].note == ["longer text"] and got["uid=2"].mail == []


def test_lines_in_another_charset(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_bytes("naïve, \"é\"\n  x ".encode("latin-1"))
    assert rows(files.read_lines(spark, str(tmp_path), encoding="ISO-8859-1")) == [("  x ",), ('naïve, "é"',)]


def test_delimited_flows(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("1,a\nx,b\n2,c\n")
    flows = files.delimited_flows(spark, str(tmp_path), T.StructType.fromDDL("n int, v string"))
    assert rows(flows.accepted) == [(1, "a"), (2, "c")]
    assert rows(flows.rejected, "_bad_row") == [("x,b",)]


def test_fixed_width_pads_and_refuses_to_cut(spark):
    df = spark.createDataFrame([(1234567,)], "n int")
    with pytest.raises(Exception, match="longer than 4"):
        df.select(files.fixed_width_line([("n", 4, "right")])).collect()
    df = spark.createDataFrame([(5, "abcd", None)], "n int, s string, z string")
    line = df.select(files.fixed_width_line([("n", 3, "right"), ("s", 4, "left"), ("z", 2, "left")])).first()[0]
    assert line == "  5abcd  "


def test_inline_generated_and_cached(spark, rows):
    assert rows(TB.inline_rows(spark, [(1, "a")], "k int, v string")) == [(1, "a")]
    assert TB.generate_rows(spark, 10, {"k": lambda i: i * 2}, partitions=3).agg(F.sum("k")).first()[0] == 90
    cache = TB.FlowCache()
    cache.put("x", spark.range(3))
    assert cache.get("x").count() == 3
    cache.release()
    with pytest.raises(KeyError):
        cache.get("x")


@pytest.fixture
def table(spark):
    names = []

    def make(name):
        names.append(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        return name

    yield make
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables_statements_and_load_types(spark, table, rows):
    name = table("io_plain")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    TB.save_by_load_type(df, name, full=True)
    TB.save_by_load_type(df, name, full=False)
    assert TB.read_table(spark, name).count() == 2
    TB.save_by_load_type(df, name, full=True)
    TB.run_statement(spark, f"INSERT INTO {name} SELECT k + :step, v FROM extra", {"step": 1}, extra=df)
    assert rows(TB.read_table(spark, name)) == [(1, "a"), (2, "a")]
    TB.insert_into(df.select("v", "k"), name)
    assert TB.read_table(spark, name).count() == 3


def test_merge_into_a_plain_table(spark, table, rows):
    name = table("io_merge")
    TB.merge_table(spark, name, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    TB.merge_table(spark, name, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), ["k"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_touches_only_the_partitions_it_needs(spark, table, rows):
    name = table("io_parts")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (4, "d", None)], "k int, v string, p string")
    TB.merge_table(spark, name, first, ["k"], partition_by="p")
    files_before = {r[0] for r in spark.table(name).filter("p = 'z'").select(F.input_file_name()).distinct().collect()}
    # key 2 moves from y to x, key 5 is new, z is not touched
    change = spark.createDataFrame([(2, "B", "x"), (5, "e", "w")], "k int, v string, p string")
    TB.merge_table(spark, name, change, ["k"], partition_by="p")
    assert rows(spark.table(name)) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "z"), (4, "d", None), (5, "e", "w")]
    assert {r[0] for r in spark.table(name).filter("p = 'z'").select(F.input_file_name()).distinct().collect()} == files_before
    TB.merge_table(spark, name, change, ["k"], "DELETE", partition_by="p")
    assert rows(spark.table(name), "k") == [(1,), (3,), (4,)]
    assert rows(spark.sql(f"SHOW PARTITIONS {name}")) == [("p=__HIVE_DEFAULT_PARTITION__",), ("p=x",), ("p=z",)]


EVENTS = "k int, v string, at timestamp_ntz, gone boolean"


def _land(spark, folder, *items):
    rows = [(k, v, dt.datetime(2025, 1, day), gone) for k, v, day, gone in items]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_stream_upsert_over_runs(spark, tmp_path, rows):
    land, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    newest = [F.desc("at")]

    def run():
        stream_upsert(read_file_stream(spark, land, EVENTS), out, state, ["k"], newest).awaitTermination()
        return rows(upsert_state(spark, out, ["k"], newest, "gone"))

    _land(spark, land, (1, "a", 1, False), (1, "b", 2, False), (2, "c", 1, None))
    assert [r[:2] for r in run()] == [(1, "b"), (2, "c")]
    # an older change that comes late does not win, a delete removes its key
    _land(spark, land, (1, "late", 1, False), (2, "c", 3, True), (3, "n", 1, False))
    assert [r[:2] for r in run()] == [(1, "b"), (3, "n")]
    assert [r[:2] for r in run()] == [(1, "b"), (3, "n")]
    folded = str(tmp_path / "folded")
    assert compact(spark, out, folded, ["k"], newest) == 1
    assert [r[:2] for r in rows(upsert_state(spark, folded, ["k"], newest, "gone"))] == [(1, "b"), (3, "n")]


def test_available_now_takes_only_new_files(spark, tmp_path):
    land, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for day in (1, 2):
        _land(spark, land, (day, "a", day, False))
        load_available(read_file_stream(spark, land, EVENTS), out, state)
        assert spark.read.parquet(out).count() == day


def test_topic_options():
    got = topic_options("h:9092", "t", failOnDataLoss=False)
    assert got["subscribe"] == "t" and got["failOnDataLoss"] == "False"


def test_insert_refuses_unknown_columns(spark):
    spark.sql("CREATE TABLE narrow_target (k int, v string) USING parquet")
    with pytest.raises(ValueError, match="no columns"):
        TB.insert_into(spark.createDataFrame([(1, "a", 2)], "k int, v string, extra int"), "narrow_target")
    spark.sql("DROP TABLE narrow_target")


def test_append_adds_columns_and_widens(spark, rows, tmp_path):
    name = "evolving_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    TB.save_table(spark.createDataFrame([(1, "a", "x")], "id bigint, v string, p string"), name, "overwrite", ["p"], path=str(tmp_path / "t"))
    TB.save_table(spark.createDataFrame([("y", 2, 0.5)], "p string, ID int, `new col` double"), name)
    assert rows(spark.read.table(name), "id", "v", "new col", "p") == [(1, "a", None, "x"), (2, None, 0.5, "y")]
    TB.save_table(spark.createDataFrame([(3, "c", "x", 1.5)], "id bigint, v string, p string, `new col` double"), name, merge_schema=False)
    assert spark.read.table(name).count() == 3
    with pytest.raises(ValueError, match="does not fit"):
        TB.save_table(spark.createDataFrame([("z", "x")], "id string, p string"), name)
    with pytest.raises(ValueError, match="differs in columns"):
        TB.save_table(spark.createDataFrame([(4, "x")], "id bigint, p string"), name, merge_schema=False)
    with pytest.raises(ValueError, match="is partitioned by"):
        TB.save_table(spark.createDataFrame([(4, "x")], "id bigint, p string"), name, partition_by=["v"])
    assert spark.read.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_merge_switches_versions_in_one_step(spark, rows, tmp_path, monkeypatch):
    name = "switched_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    TB.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"), name, "overwrite", path=str(tmp_path / "t"))
    assert TB.old_versions(spark, name) == []
    TB.merge_table(spark, name, spark.createDataFrame([(2, "B"), (3, "C")], "id bigint, v string"), ["id"])
    second = [(1, "a"), (2, "B"), (3, "C")]
    assert rows(spark.read.table(name)) == second and len(TB.old_versions(spark, name)) == 1
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == [(1, "a"), (2, "b")]  # readers of the old state keep its files
    # killed while the new state is written: after its files, before the catalog knows them
    real = type(spark).sql

    def killed(self, statement, *args, **more):
        if statement.startswith("ALTER TABLE"):
            raise RuntimeError("killed")
        return real(self, statement, *args, **more)

    monkeypatch.setattr(type(spark), "sql", killed)
    with pytest.raises(RuntimeError, match="killed"):
        TB.merge_table(spark, name, spark.createDataFrame([(1, "X")], "id bigint, v string"), ["id"])
    monkeypatch.setattr(type(spark), "sql", real)
    assert rows(spark.read.table(name)) == second
    TB.merge_table(spark, name, spark.createDataFrame([(1, "X")], "id bigint, v string"), ["id"], action="DELETE")
    assert rows(spark.read.table(name)) == second[1:] and len(TB.old_versions(spark, name)) == 3
    spark.sql(f"INSERT INTO {name} VALUES (9, 'z')")
    assert spark.read.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_nested_xml_files_hold_a_bounded_number_of_elements(spark, tmp_path, monkeypatch):
    """One task reads a whole XML file, so one writer of many rows makes several files."""
    monkeypatch.setattr(files, "XML_ROWS", 4, raising=False)
    rows = spark.range(10).selectExpr("id AS order_id", "array(named_struct('no', 1, 'quantity', id / 2)) AS line").coalesce(1)
    files.write_xml(rows, str(tmp_path / "tree"), "orders", "order")
    assert len(list((tmp_path / "tree").glob("part-*"))) == 3
    read = files.read_xml(spark, str(tmp_path / "tree"), "order", "order_id bigint, line array<struct<no:int,quantity:double>>")
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))


def test_xml_files_of_one_writer_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "XML_ROWS", 4, raising=False)
    rows = spark.range(10).selectExpr("id AS k", "concat('n', id) AS name").coalesce(1)
    files.write_xml(rows, str(tmp_path / "cut"), "parts", "part")
    files.write_xml(rows, str(tmp_path / "whole"), "parts", "part", max_rows_per_file=0)
    assert [len(list((tmp_path / d).glob("part-*"))) for d in ("cut", "whole")] == [3, 1]
    got, whole = (sorted(map(tuple, files.read_xml(spark, str(tmp_path / d), "part", "k bigint, name string").collect())) for d in ("cut", "whole"))
    assert got == whole == sorted(map(tuple, rows.collect()))


def test_buckets_grow_with_the_tables(spark, sf_dir, monkeypatch):
    """With few rows to a bucket the scans show more buckets than the least number, and the counts stay."""
    monkeypatch.setattr(TB, "BUCKET_ROWS", 500, raising=False)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    joined = QUERIES["bucketed_join"](spark, sf_dir)
    buckets = {int(n) for n in re.findall(r"SelectedBucketsCount: \d+ out of (\d+)", joined._jdf.queryExecution().executedPlan().toString())}
    assert buckets == {-(-lines.count() // 500)}
    assert joined.agg(F.sum("lines")).first()[0] == lines.count()
