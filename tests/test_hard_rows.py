"""Rows on which operators once lost or changed data."""

import base64
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowloom.functions import dates as D
from rowloom.functions import numbers as U
from rowloom.operators.history import scd2
from rowloom.operators.incremental import changes_since, empty_control, watermark_load
from rowloom.sources import files
from rowloom.streaming.upsert import compact, upsert_state

NOON = dt.datetime(2024, 1, 1, 12)


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "windows-1252"])
def test_encoded_lines_keep_blank_lines_and_control_characters(spark, tmp_path, encoding):
    (tmp_path / "a.txt").write_bytes("é\n\nb\u0001c\r\n".encode(encoding))
    assert [r.line for r in files.read_lines(spark, str(tmp_path), encoding=encoding).collect()] == ["é", "", "b\u0001c"]


def test_wide_charsets_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="UTF-16"):
        files.read_lines(spark, str(tmp_path), encoding="UTF-16")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_entries_with_any_line_end_and_base64(spark, tmp_path, end):
    coded = base64.b64encode("naïve: x".encode()).decode()
    lines = ["dn: a", "mail: one@example.org", f"note:: {coded}", "", "dn: b", "note: x", " y", ""]
    (tmp_path / "a.ldif").write_bytes(end.join(lines).encode())
    got = {r.dn[0]: (r.mail, r.note) for r in files.read_entries(spark, str(tmp_path), ["dn", "mail", "note"]).collect()}
    assert got == {"a": (["one@example.org"], ["naïve: x"]), "b": ([], ["xy"])}


def test_truncate_keeps_decimals_exact(spark):
    big = Decimal("12345678901234567890.99")
    df = spark.createDataFrame([(big,), (-big,), (None,)], "x decimal(24,2)")
    assert [r[0] for r in df.select(U.truncate("x", 1)).collect()] == [Decimal("12345678901234567890.9"), Decimal("-12345678901234567890.9"), None]
    assert df.select(U.truncate("x", -2)).first()[0] == Decimal("12345678901234567800")


def test_add_months_keeps_the_time_of_day(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 2, 28, 13, 45),), (dt.datetime(2023, 1, 30, 1),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(D.add_months("t", 1)).collect()] == [dt.datetime(2023, 3, 31, 13, 45), dt.datetime(2023, 2, 28, 1), None]
    assert df.select(D.add_months(F.lit(dt.date(2024, 2, 29)), -1)).first()[0] == dt.date(2024, 1, 31)


def test_utc_now_does_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = spark.range(1).select(D.utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(got - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_scd2_sees_changes_that_share_a_hash(spark):
    schema = "k int, part string, a string, b string"
    old = spark.createDataFrame([(1, "x", "x||y", "z"), (1, "y", None, "same"), (2, "x", "kept", None)], schema)
    new = spark.createDataFrame([(1, "x", "x", "y||z"), (1, "y", "NULL", "same"), (2, "x", "kept", None)], schema)
    first = scd2(None, old, ["k", "part"], now=NOON, surrogate="sk")
    state = scd2(first, new, ["k", "part"], now=NOON + dt.timedelta(days=1), surrogate="sk").collect()
    assert sorted((r.k, r.part, r.a or "", r.is_current) for r in state) == [
        (1, "x", "x", True), (1, "x", "x||y", False), (1, "y", "", False), (1, "y", "NULL", True), (2, "x", "kept", True),
    ]


def test_numeric_watermarks(spark):
    source = spark.createDataFrame([(1, 5), (2, 9), (3, 10), (4, None)], "id int, seq bigint")
    load = watermark_load(source, None, empty_control(spark), "t", ["id"], "seq", NOON)
    assert sorted(r.id for r in load.target.collect()) == [1, 2, 3]
    assert load.control.first().last_watermark == "10"
    assert [r.id for r in changes_since(source, "seq", "9").collect()] == [3]
    assert sorted(r.id for r in changes_since(source, "seq", "10", "1").collect()) == [2, 3]


def test_target_and_watermark_come_from_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.createDataFrame([(1, 5)], "id int, seq bigint").write.parquet(path)
    load = watermark_load(spark.read.parquet(path), None, empty_control(spark), "t", ["id"], "seq", NOON)
    spark.createDataFrame([(2, 7)], "id int, seq bigint").write.mode("append").parquet(path)
    assert load.control.first().last_watermark == "5"
    assert [r.id for r in load.target.collect()] == [1]


def test_a_stream_goes_on_after_compaction(spark, tmp_path):
    path, folded = str(tmp_path / "batches"), str(tmp_path / "folded")

    def batch(number, *rows):
        spark.createDataFrame(list(rows), "k int, v int, gone boolean").write.parquet(f"{path}/_batch={number}")

    def state():
        return sorted((r.k, r.v) for r in upsert_state(spark, path, ["k"], [F.desc("v")], "gone", base=folded).collect())

    batch(0, (1, 1, False), (2, 1, False))
    batch(1, (2, 2, True), (3, 2, False))
    assert compact(spark, path, folded, ["k"], [F.desc("v")]) == 1
    assert state() == [(1, 1), (3, 2)]
    batch(2, (1, 3, False))
    assert state() == [(1, 3), (3, 2)]
    assert compact(spark, path, folded, ["k"], [F.desc("v")], base=folded) == 2
    assert compact(spark, path, folded, ["k"], [F.desc("v")], base=folded) == 2
    assert state() == [(1, 3), (3, 2)]
