"""Dialect functions on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.constants import clock
from rowloom.functions import dates as D
from rowloom.functions import jsonpath as J
from rowloom.functions import nulls as N
from rowloom.functions import numbers as U
from rowloom.functions import text as X
from rowloom.plans.registry import Tables, query

RUN_AT = dt.datetime(2026, 1, 1, 6, 30)


@query("fn_null", """
WITH c AS (SELECT c_custkey, nullif(c_nationkey, 3) AS nation, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS seg FROM customer)
SELECT c_custkey, coalesce(nation, -1) AS nvl, CASE WHEN nation IS NOT NULL THEN 'known' ELSE 'unknown' END AS nvl2,
       coalesce(bal, 0) AS zeroifnull, seg IS NULL OR length(seg) = 0 AS is_empty, nation IS NULL AS is_null, nation IS NOT NULL AS is_not_null
FROM c
""")
def fn_null(t: Tables) -> DataFrame:
    df = t.customer.select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END").alias("bal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("seg"),
    )
    return df.select(
        "c_custkey", N.if_null("nation", -1).alias("nvl"), N.null_switch("nation", F.lit("known"), F.lit("unknown")).alias("nvl2"),
        N.zero_if_null("bal").alias("zeroifnull"), N.is_empty("seg").alias("is_empty"), N.is_null("nation").alias("is_null"),
        N.is_not_null("nation").alias("is_not_null"),
    )


@query("fn_decode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'other' END AS word,
       CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 1 ELSE 0 END AS null_found, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS iff
FROM orders
""")
def fn_decode(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", N.decode("o_orderstatus", "O", "open", "F", "filled", "other").alias("word"),
        N.decode(F.nullif("o_orderstatus", F.lit("P")), None, 1, 0).alias("null_found"),
        N.iff(F.col("o_totalprice") > 200000, F.lit("big"), F.lit("small")).alias("iff"),
    )


@query("fn_text", """
WITH c AS (SELECT c_custkey, '  ' || c_name || ' ' AS padded, c_name, c_mktsegment FROM customer)
SELECT c_custkey, trim(padded) AS trimmed, ltrim(padded) AS ltrimmed, rtrim(padded) AS rtrimmed, upper(c_name) AS up, lower(c_name) AS low,
       left(c_name, 4) AS lft, right(c_name, 4) AS rgt, substr(c_name, 3, 5) AS sub, substr(c_name, -4, 2) AS sub_end, length(padded) AS len,
       length(rtrim(padded)) AS len_sql, replace(c_name, '0', 'o') AS repl, c_name || '/' || c_mktsegment AS cat,
       lpad(c_mktsegment, 12, '.') AS lp, rpad(c_mktsegment, 12, '.') AS rp, reverse(c_name) AS rev, trim(c_name, 'C0') AS stripped
FROM c
""")
def fn_text(t: Tables) -> DataFrame:
    df = t.customer.withColumn("padded", F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    return df.select(
        "c_custkey", X.trim("padded").alias("trimmed"), X.trim("padded", side="leading").alias("ltrimmed"),
        X.trim("padded", side="trailing").alias("rtrimmed"), X.upper("c_name").alias("up"), X.lower("c_name").alias("low"),
        X.left("c_name", 4).alias("lft"), X.right("c_name", 4).alias("rgt"), X.substr("c_name", 3, 5).alias("sub"),
        X.substr("c_name", -4, 2).alias("sub_end"), X.length("padded").alias("len"), X.length_no_trailing("padded").alias("len_sql"),
        X.replace("c_name", "0", "o").alias("repl"), X.concat("c_name", F.lit("/"), "c_mktsegment").alias("cat"),
        X.pad("c_mktsegment", 12, ".").alias("lp"), X.pad("c_mktsegment", 12, ".", "right").alias("rp"), X.reverse("c_name").alias("rev"),
        X.trim("c_name", "C0").alias("stripped"),
    )


@query("fn_position", """
SELECT page_id, instr(url, '/') AS first_slash, instr(url, 'nowhere') AS absent,
       CASE WHEN instr(substr(url, 9), '/') = 0 THEN 0 ELSE instr(substr(url, 9), '/') + 8 END AS after_scheme FROM pages
""")
def fn_position(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", X.position("url", "/").alias("first_slash"), X.position("url", "nowhere").alias("absent"),
        X.position("url", "/", 9).alias("after_scheme"),
    )


@query("fn_overlay", """
SELECT c_custkey, substr(c_name, 1, 2) || '**' || substr(c_name, 6) AS stuffed, CAST(NULL AS VARCHAR) AS outside FROM customer
""")
def fn_overlay(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", X.overlay("c_name", 3, 3, "**").alias("stuffed"), X.overlay("c_name", 99, 1, "x").alias("outside"))


@query("fn_concat", """
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)
SELECT c_custkey, c_name || seg AS strict, concat(c_name, seg) AS lenient, concat_ws('-', c_name, seg, 'x') AS ws FROM c
""")
def fn_concat(t: Tables) -> DataFrame:
    df = t.customer.withColumn("seg", F.expr("CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END"))
    return df.select(
        "c_custkey", X.concat("c_name", "seg").alias("strict"), X.concat("c_name", "seg", null_as_empty=True).alias("lenient"),
        X.concat_ws("-", "c_name", "seg", F.lit("x")).alias("ws"),
    )


@query("fn_substring_index", """
SELECT page_id, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) AS origin,
       split_part(url, '/', len(string_split(url, '/'))) AS last FROM pages
""")
def fn_substring_index(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.substring_index("url", "/", 3).alias("origin"), X.substring_index("url", "/", -1).alias("last"))


@query("fn_distance", """
SELECT p_partkey, levenshtein(p_name, p_type) AS edits, levenshtein(lower(p_brand), 'brand#10') AS brand_edits FROM part
""")
def fn_distance(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", X.edit_distance("p_name", "p_type").alias("edits"), X.edit_distance(F.lower("p_brand"), F.lit("brand#10")).alias("brand_edits")
    )


@query("fn_phonetic")
def fn_phonetic(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.phonetic(F.substring_index("p_name", " ", 1)).alias("sound"))


@query("fn_date_add", """
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN last_day(o_orderdate + INTERVAL 1 MONTH) + CAST(o_orderdate AS TIME) ELSE o_orderdate + INTERVAL 1 MONTH END AS month_on,
       CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN last_day(o_orderdate - INTERVAL 3 MONTH) + CAST(o_orderdate AS TIME) ELSE o_orderdate - INTERVAL 3 MONTH END AS quarter_back,
       o_orderdate + INTERVAL 10 DAY AS days_on, o_orderdate - INTERVAL 5 HOUR AS hours_back, o_orderdate + INTERVAL 1 YEAR AS year_on,
       o_orderdate + INTERVAL 2 WEEK AS weeks_on, o_orderdate + INTERVAL 6 MONTH AS quarters_on, o_orderdate + INTERVAL 90 SECOND AS secs_on
FROM orders
""")
def fn_date_add(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", D.add_months(d, 1).alias("month_on"), D.add_months(d, -3).alias("quarter_back"), D.add(d, "dd", 10).alias("days_on"),
        D.add(d, "hour", -5).alias("hours_back"), D.add(d, "yyyy", 1).alias("year_on"), D.add(d, "week", 2).alias("weeks_on"),
        D.add(d, "quarter", 2).alias("quarters_on"), D.add(d, "ss", 90).alias("secs_on"),
    )


@query("fn_add_months_time", """
SELECT event_id, CASE WHEN CAST(ts AS DATE) = last_day(ts) THEN last_day(ts + INTERVAL 1 MONTH) + CAST(ts AS TIME) ELSE ts + INTERVAL 1 MONTH END AS month_on FROM events
""")
def fn_add_months_time(t: Tables) -> DataFrame:
    return t.events.select("event_id", D.add_months("ts", 1).alias("month_on"))


@query("fn_date_diff", """
WITH e AS (SELECT event_id, ts, TIMESTAMP '2023-12-31 23:59:30' AS base FROM events)
SELECT event_id, date_diff('year', base, ts) AS years, date_diff('quarter', base, ts) AS quarters, date_diff('month', base, ts) AS months,
       date_diff('day', base, ts) AS days, date_diff('hour', base, ts) AS hours, date_diff('minute', base, ts) AS minutes,
       date_diff('second', base, ts) AS seconds, CAST(date_diff('day', base, ts) AS INTEGER) AS days_only,
       CAST((date_diff('day', base, ts) - dayofweek(ts) + dayofweek(base)) // 7 AS BIGINT) AS weeks
FROM e
""")
def fn_date_diff(t: Tables) -> DataFrame:
    base = clock(dt.datetime(2023, 12, 31, 23, 59, 30))
    units = {"years": "year", "quarters": "quarter", "months": "mm", "days": "day", "hours": "hh", "minutes": "mi", "seconds": "ss", "weeks": "week"}
    return t.events.select(
        "event_id", *[D.boundaries_between(u, base, "ts").alias(n) for n, u in units.items()], D.days_between(base, "ts").alias("days_only")
    )


@query("fn_months", """
SELECT o_orderkey, round(CASE
    WHEN day(o_orderdate) = 31 AND false THEN 0
    ELSE date_diff('month', DATE '1995-01-15', CAST(o_orderdate AS DATE)) + (day(o_orderdate) - 15) / 31.0 END, 6) AS months
FROM orders
""")
def fn_months(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(D.months_between("o_orderdate", F.lit(dt.date(1995, 1, 15))), 6).alias("months"))


@query("fn_date_part", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d,
       CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS mi, monthname(ts) AS month_name, dayname(ts) AS day_name,
       date_trunc('month', ts) AS month_start, CAST(sign(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 00:00:00')) AS INTEGER) AS side
FROM events
""")
def fn_date_part(t: Tables) -> DataFrame:
    mid = clock(dt.datetime(2024, 1, 15))
    units = {"y": "yy", "q": "qq", "m": "mm", "d": "dd", "h": "hh", "mi": "mi"}
    return t.events.select(
        "event_id", *[D.part(u, "ts").alias(n) for n, u in units.items()], D.part_name("month", "ts").alias("month_name"),
        D.part_name("weekday", "ts").alias("day_name"), D.truncate("ts", "month").cast("timestamp_ntz").alias("month_start"), D.compare("ts", mid).alias("side"),
    )


@query("fn_format", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%d/%m/%y') AS short, strftime(ts, '%Y%m%dT%H') AS compact,
       strftime(ts, '%b %d, %Y %I:%M %p') AS long_form, strftime(ts, '%Y-%m') AS java_form FROM events
""")
def fn_format(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", D.format_date("ts", "YYYY-MM-DD HH24:MI:SS").alias("iso"), D.format_date("ts", "%d/%m/%y", "mysql").alias("short"),
        D.format_date("ts", 'YYYYMMDD"T"HH24').alias("compact"), D.format_date("ts", "%b %d, %Y %I:%i %p", "mysql").alias("long_form"),
        D.format_date("ts", "yyyy-MM", "java").alias("java_form"),
    )


@query("fn_format_elements", """
SELECT event_id, strftime(ts, '%y') AS rr, strftime(ts, '%G-W%V') AS iso_week, CAST(CAST(julian(CAST(ts AS DATE)) AS BIGINT) AS VARCHAR) AS julian_day,
  lpad(CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS VARCHAR), 5, '0') AS day_seconds, strftime(ts, '%Y') || ' Q' || quarter(ts) AS quarter,
  CAST(dayofweek(ts) + 1 AS VARCHAR) || lpad(CAST((dayofyear(ts) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS day_and_week,
  CAST(day(ts) AS VARCHAR) || CASE WHEN day(ts) IN (11, 12, 13) THEN 'th' WHEN day(ts) % 10 = 1 THEN 'st' WHEN day(ts) % 10 = 2 THEN 'nd'
    WHEN day(ts) % 10 = 3 THEN 'rd' ELSE 'th' END || strftime(ts, ' %b') AS ordinal,
  strftime(ts, '%U') AS sunday_week, strftime(ts, '%w') AS weekday, strftime(ts, '%d/%m/%Y %I:%M %p') AS net_form FROM events
""")
def fn_format_elements(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", D.format_date("ts", "RR").alias("rr"), D.format_date("ts", 'IYYY-"W"IW').alias("iso_week"), D.format_date("ts", "J").alias("julian_day"),
        D.format_date("ts", "SSSSS").alias("day_seconds"), D.format_date("ts", 'RRRR "Q"Q').alias("quarter"), D.format_date("ts", "DWW").alias("day_and_week"),
        D.format_date("ts", "%D %b", "mysql").alias("ordinal"), D.format_date("ts", "%U", "mysql").alias("sunday_week"),
        D.format_date("ts", "%w", "mysql").alias("weekday"), D.format_date("ts", "dd/MM/yyyy hh:mm tt", "sqlserver").alias("net_form"),
    )


@query("fn_parse_elements", """
SELECT event_id, CAST(ts AS DATE) AS by_julian, CAST(ts AS DATE) AS by_window, CAST(ts AS DATE) AS by_ordinal, date_trunc('second', ts) AS by_seconds FROM events
""")
def fn_parse_elements(t: Tables) -> DataFrame:
    """What was written is read again."""
    return t.events.select(
        "event_id", D.parse_date(D.format_date("ts", "J"), "J").alias("by_julian"), D.parse_date(D.format_date("ts", "DD-MON-RR"), "DD-MON-RR").alias("by_window"),
        D.parse_date(D.format_date("ts", "%M %D, %Y", "mysql"), "%M %D, %Y", "mysql").alias("by_ordinal"),
        D.parse_timestamp(D.format_date("ts", "RRRR/MM/DD SSSSS"), "RRRR/MM/DD SSSSS").alias("by_seconds"),
    )


@query("fn_parse", """
SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS second, CAST(NULL AS DATE) AS bad,
       CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch FROM events
""")
def fn_parse(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", D.parse_date(D.format_date("ts", "%d.%m.%Y", "mysql"), "%d.%m.%Y", "mysql").alias("day"),
        D.parse_timestamp(D.format_date("ts", "DD-MM-YYYY HH24:MI:SS"), "DD-MM-YYYY HH24:MI:SS").alias("second"),
        D.parse_date("event_type", "YYYY-MM-DD", strict=False).alias("bad"), D.epoch_seconds("ts").alias("epoch"),
    )


@query("fn_now", """
SELECT o_orderkey, TIMESTAMP '2026-01-01 06:30:00' AS now_at, DATE '2026-01-01' AS today,
       date_diff('day', o_orderdate, TIMESTAMP '2026-01-01 06:30:00') AS age FROM orders
""")
def fn_now(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", D.now(RUN_AT).alias("now_at"), D.today(RUN_AT).alias("today"),
        D.boundaries_between("day", "o_orderdate", D.now(RUN_AT)).alias("age"),
    )


@query("fn_convert", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no, TRY_CAST(p_brand AS INTEGER) AS bad,
       CAST(TRY_CAST(' ' || p_size || '.50 ' AS DECIMAL(18,2)) AS DOUBLE) AS num, CAST(p_size AS BIGINT) AS big,
       CASE WHEN p_size % 2 = 0 THEN true ELSE false END AS even
FROM part
""")
def fn_convert(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".50 "))
    word = F.when(F.col("p_size") % 2 == 0, " Yes").otherwise("no")
    return t.part.select(
        "p_partkey", U.convert("p_size", "string").alias("size_text"), U.convert(X.substring_index("p_brand", "#", -1), "int").alias("brand_no"),
        U.convert("p_brand", "int", strict=False).alias("bad"), U.to_number(padded, 18, 2).cast("double").alias("num"),
        U.convert("p_size", "bigint").alias("big"), U.parse_boolean(word).alias("even"),
    )


@query("fn_trunc", """
SELECT c_custkey, CAST(trunc(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS whole,
       CAST(trunc(CAST(c_acctbal AS DECIMAL(18,2)) * 10) / 10 AS DOUBLE) AS tenth, CAST(trunc(CAST(c_acctbal AS DECIMAL(18,2)) / 100) * 100 AS DOUBLE) AS hundreds,
       abs(c_acctbal) AS absolute, round(c_acctbal) AS rounded, CAST(ceil(c_acctbal) AS BIGINT) AS up, CAST(floor(c_acctbal) AS BIGINT) AS down, round(sqrt(abs(c_acctbal)), 6) AS root
FROM customer
""")
def fn_trunc(t: Tables) -> DataFrame:
    b = "c_acctbal"
    return t.customer.select(
        "c_custkey", U.truncate(b).alias("whole"), U.truncate(b, 1).alias("tenth"), U.truncate(b, -2).alias("hundreds"), U.absolute(b).alias("absolute"),
        U.rounded(b).alias("rounded"), U.ceiling(b).alias("up"), U.floor(b).alias("down"), F.round(U.square_root(U.absolute(b)), 6).alias("root"),
    )


@query("fn_json_path", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
       event_type AS nested, CAST(NULL AS INTEGER) AS bad FROM events
""")
def fn_json_path(t: Tables) -> DataFrame:
    doc = F.to_json(F.struct(F.struct(F.array(F.col("event_type")).alias("tags")).alias("meta")))
    df = t.events.withColumn("doc", doc)
    return df.select(
        "event_id", J.path("props", "k").alias("k"), J.typed_path("props", "$.k", "int").alias("k_int"),
        J.path("doc", "meta", "tags", 0).alias("nested"), J.typed_path("event_type", "$.k", "int").alias("bad"),
    )


@query("fn_flatten", """
SELECT c_custkey, unnest(string_split(c_name, '#')) AS item FROM customer
""")
def fn_flatten(t: Tables) -> DataFrame:
    df = t.customer.withColumn("doc", F.to_json(F.split("c_name", "#")))
    return df.select("c_custkey", F.explode(J.items("doc")).alias("item"))


@query("fn_json_entries", """
SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
""")
def fn_json_entries(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.explode(J.entries("props")))
