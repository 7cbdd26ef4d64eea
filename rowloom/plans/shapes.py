"""Projection, filtering and row shaping on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators import shape as S
from rowloom.operators.keys import surrogate_key
from rowloom.plans.registry import Tables, query
from rowloom.schema import conform
from rowloom.session import scratch_path

RUN_AT = dt.datetime(2026, 1, 1, 6, 30)


@query("map_variables", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS gross,
       l_returnflag || '/' || l_linestatus AS flags
FROM lineitem
""")
def map_variables(t: Tables) -> DataFrame:
    return S.map_columns(
        t.lineitem,
        {
            "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey",
            "l_suppkey": "l_suppkey", "net": "net_exact", "gross": "net_exact * (1 + tax)",
            "flags": F.concat_ws("/", "l_returnflag", "l_linestatus"),
        },
        variables={
            "tax": "cast(l_tax as decimal(4,2))",
            "net_exact": "cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))",
        },
        types={"net": "double", "gross": "double"},
    )


def _outputs(t: Tables) -> dict[str, DataFrame]:
    columns = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey", "l_quantity": "l_quantity"}
    return S.map_outputs(
        t.lineitem,
        {"returned": ("l_returnflag = 'R'", columns), "bulk": ("l_quantity >= 40", columns)},
        rejects={"rest": columns},
    )


_OUT = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE "


@query("map_output_returned", _OUT + "l_returnflag = 'R'")
def map_output_returned(t: Tables) -> DataFrame:
    return _outputs(t)["returned"]


@query("map_output_rejects", _OUT + "l_returnflag <> 'R' AND l_quantity < 40")
def map_output_rejects(t: Tables) -> DataFrame:
    return _outputs(t)["rest"]


@query("conditional_col", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'HIGH' WHEN o_totalprice > 100000 THEN 'NORMAL' ELSE 'LOW' END AS band
FROM orders
""")
def conditional_col(t: Tables) -> DataFrame:
    band = S.choose([("o_totalprice > 300000", "HIGH"), ("o_totalprice > 100000", "NORMAL")], "LOW")
    return t.orders.select("o_orderkey", band.alias("band"))


_NULLABLE = "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END"


def _lines_with_nulls(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr(_NULLABLE).alias("discount")
    )


@query("filter_accepted", f"""
SELECT l_orderkey, l_linenumber, l_partkey, discount FROM (SELECT *, {_NULLABLE} AS discount FROM lineitem) WHERE discount > 0.05
""")
def filter_accepted(t: Tables) -> DataFrame:
    return S.filter_flows(_lines_with_nulls(t), "discount > 0.05").accepted


@query("filter_rejected", f"""
SELECT l_orderkey, l_linenumber, l_partkey, discount FROM (SELECT *, {_NULLABLE} AS discount FROM lineitem)
WHERE discount IS NULL OR discount <= 0.05
""")
def filter_rejected(t: Tables) -> DataFrame:
    return S.filter_flows(_lines_with_nulls(t), "discount > 0.05").rejected


_BRANCHES = {"large": "l_quantity > 30", "discounted": "l_discount > 0.05", "late": "l_shipdate >= timestamp_ntz'2000-01-01'"}


@query("split_flows", """
SELECT 'large' AS branch, count(*) AS n FROM lineitem WHERE l_quantity > 30
UNION ALL SELECT 'discounted', count(*) FROM lineitem WHERE l_discount > 0.05
UNION ALL SELECT 'late', count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'
""")
def split_flows(t: Tables) -> DataFrame:
    parts = [d.agg(F.lit(n).alias("branch"), F.count(F.lit(1)).alias("n")) for n, d in S.split_flows(t.lineitem, _BRANCHES).items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("split_exclusive", """
SELECT CASE WHEN l_quantity > 30 THEN 'large' WHEN l_discount > 0.05 THEN 'discounted' ELSE 'late' END AS branch,
       l_orderkey, l_linenumber, l_partkey
FROM lineitem WHERE l_quantity > 30 OR l_discount > 0.05 OR l_shipdate >= TIMESTAMP '2000-01-01'
""")
def split_exclusive(t: Tables) -> DataFrame:
    flows = S.split_flows(t.lineitem, _BRANCHES, exclusive=True)
    parts = [d.select(F.lit(n).alias("branch"), "l_orderkey", "l_linenumber", "l_partkey") for n, d in flows.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("select_columns", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def select_columns(t: Tables) -> DataFrame:
    return S.drop_columns(S.keep_columns(t.part, ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "absent"]), ["p_size"])


@query("dynamic_columns", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_orderkey FROM lineitem")
def dynamic_columns(t: Tables) -> DataFrame:
    return S.keep_columns(t.lineitem, lambda f: isinstance(f.dataType, T.DoubleType) or f.name.endswith("orderkey"))


@query("rename_cast_default", """
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0.0) AS balance, c_mktsegment
FROM customer
""")
def rename_cast_default(t: Tables) -> DataFrame:
    df = t.customer.withColumn("c_acctbal", F.expr("CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END"))
    df = S.rename(df, {"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance", "absent": "x"})
    df = S.cast_columns(df, {"c_nationkey": "string", "absent": "int"})
    return S.fill_defaults(df, {"balance": 0.0, "absent": 1})


PART_SPEC = [
    {"name": "p_partkey", "type": "NUMBER(18,0)", "key": True, "nullable": False},
    {"name": "p_name", "type": "VARCHAR2(100)", "length": 100},
    {"name": "p_size", "type": "NUMBER(6,0)"},
    {"name": "p_retailprice", "type": "NUMBER(12,2)"},
    {"name": "p_brand", "type": "NUMBER(4,0)"},
    {"name": "status", "type": "CHAR(1)", "default": "A"},
]


@query("conform_schema", """
SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS p_retailprice,
       TRY_CAST(p_brand AS BIGINT) AS p_brand, 'A' AS status
FROM part
""")
def conform_schema(t: Tables) -> DataFrame:
    return conform(t.part, PART_SPEC, "oracle").withColumn("p_retailprice", F.col("p_retailprice").cast("double"))


@query("replace_regex", """
SELECT c_custkey, replace(regexp_replace(c_name, '[^0-9]', '', 'g'), '000', '-') AS c_name FROM customer
""")
def replace_regex(t: Tables) -> DataFrame:
    df = S.replace_text(t.customer.select("c_custkey", "c_name"), "c_name", [("[^0-9]", "")])
    return S.replace_text(df, "c_name", [("000", "-")], regex=False)


@query("normalize_words", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word
""")
def normalize_words(t: Tables) -> DataFrame:
    words = S.split_to_rows(t.documents.select("text"), "text", " ", "word", trim=False)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("unpivot_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem
""")
def unpivot_lineitem(t: Tables) -> DataFrame:
    return S.columns_to_rows(
        t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount"
    )


@query("extract_delimited", """
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_no,
       split_part(o_orderpriority, '-', 2) AS priority_name FROM orders
""")
def extract_delimited(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return S.delimited_fields(df, "o_orderpriority", "-", {"priority_no": "int", "priority_name": "string"}).drop("o_orderpriority")


@query("extract_regex", r"""
SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)/(.*)$', 1) AS scheme,
       regexp_extract(url, '^(https?)://([^/]+)/(.*)$', 2) AS host, regexp_extract(url, '^(https?)://([^/]+)/(.*)$', 3) AS rest
FROM pages WHERE regexp_matches(url, '^(https?)://([^/]+)/(.*)$')
""")
def extract_regex(t: Tables) -> DataFrame:
    fields = {"scheme": "string", "host": "string", "rest": "string"}
    return S.regex_fields(t.pages.select("page_id", "url"), "url", r"^(https?)://([^/]+)/(.*)$", fields).accepted.drop("url")


@query("extract_regex_rejects", r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[^/]+/en/')")
def extract_regex_rejects(t: Tables) -> DataFrame:
    return S.regex_fields(t.pages.select("page_id", "url"), "url", r"^https://[^/]+/en/", {}).rejected


@query("extract_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.absent') AS absent
FROM events
""")
def extract_json(t: Tables) -> DataFrame:
    df = S.json_fields(t.events.select("event_id", "props"), "props", "k int")
    return S.json_paths(df, "props", {"k_text": "$.k", "absent": "$.absent"}).drop("props")


@query("extract_xml", """
SELECT c_custkey, c_nationkey AS nation, c_mktsegment AS segment, c_name AS name_by_path FROM customer
""")
def extract_xml(t: Tables) -> DataFrame:
    xml = F.to_xml(F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")))
    df = t.customer.select("c_custkey", xml.alias("doc"))
    df = S.xml_fields(df, "doc", "nation int, segment string")
    return S.xml_paths(df, "doc", {"name_by_path": "ROW/name"}).drop("doc")


@query("audit_cols", """
SELECT n_nationkey, n_name, n_regionkey, TIMESTAMP '2026-01-01 06:30:00' AS _etl_loaded_at, 'nations' AS _etl_source,
       DATE '2026-01-01' AS _etl_run_date FROM nation
""")
def audit_cols(t: Tables) -> DataFrame:
    return S.audit_columns(t.nation, "nations", RUN_AT)


@query("row_hash", """
SELECT c_custkey, md5(c_custkey::VARCHAR || '||' || c_name || '||' || coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'NULL')) AS _row_hash,
       sha256(c_name) AS sha
FROM customer
""")
def row_hash(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_name", F.expr("CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END").alias("segment"))
    hashed = S.with_row_hash(df, ["c_custkey", "c_name", "segment"])
    return hashed.select("c_custkey", "_row_hash", S.row_hash(["c_name"], "sha256").alias("sha"))


@query("surrogate_key", """
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS sk_customer FROM customer
""")
def customer_key(t: Tables) -> DataFrame:
    keyed = surrogate_key(t.customer, "sk_customer", [F.desc("c_acctbal"), "c_custkey"])
    return keyed.select("c_custkey", "c_name", "sk_customer")


@query("surrogate_key_continued", """
SELECT s_suppkey, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS c_custkey FROM supplier
""")
def surrogate_key_continued(t: Tables) -> DataFrame:
    return surrogate_key(t.supplier.select("s_suppkey"), "c_custkey", ["s_suppkey"], existing=t.customer)


@query("mask_names", """
SELECT c_custkey, sha256(c_name) AS hashed, regexp_replace(c_name, '[0-9]', '#', 'g') AS digits,
       repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) AS tail,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS chars
FROM customer
""")
def mask_names(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        S.mask("c_name").alias("hashed"),
        S.mask("c_name", "pattern", pattern="[0-9]", put="#").alias("digits"),
        S.mask("c_name", "tail").alias("tail"),
        S.mask("c_name", "chars").alias("chars"),
    )


@query("standardize_segment", """
SELECT c_custkey, coalesce(r_name, c_mktsegment) AS c_mktsegment
FROM customer LEFT JOIN (
  SELECT upper(trim(c_mktsegment)) AS variant, min(r_name) AS r_name FROM customer JOIN region
  ON length(c_mktsegment) = r_regionkey + 7 GROUP BY 1
) ON upper(trim(c_mktsegment)) = variant
""")
def standardize_segment(t: Tables) -> DataFrame:
    # segment variants mapped to a region name by their length
    reference = t.customer.select("c_mktsegment").distinct().join(
        t.region, F.length("c_mktsegment") == F.col("r_regionkey") + 7
    ).select(F.col("c_mktsegment").alias("variant"), "r_name")
    return S.standardize(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", reference, "variant", "r_name")


@query("sample_by_hash")
def sample_by_hash(t: Tables) -> DataFrame:
    return S.sample_by_key(t.orders, ["o_orderkey"], 10)


@query("sample_fraction")
def sample_fraction(t: Tables) -> DataFrame:
    return S.sample_fraction(t.lineitem, 0.1)


@query("sample_rows")
def sample_rows(t: Tables) -> DataFrame:
    return S.sample_rows(t.customer, 100, ["c_custkey"])


@query("job_parameters", """
SELECT o_orderkey, DATE '2026-01-01' AS run_date, CAST(7 AS INTEGER) AS batch, 'nightly' AS job FROM orders
WHERE o_orderdate < TIMESTAMP '1996-01-01'
""")
def job_parameters(t: Tables) -> DataFrame:
    df = S.with_parameters(t.orders, {"run_date": ("2026-01-01", "date"), "batch": ("7", "int"), "job": ("nightly", "string")})
    return df.filter("o_orderdate < timestamp_ntz'1996-01-01'").select("o_orderkey", "run_date", "batch", "job")


@query("replicated_flow", """
SELECT c_mktsegment AS grp, count(*) AS n FROM customer GROUP BY 1
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 1
""")
def replicated_flow(t: Tables) -> DataFrame:
    flows = S.FanOut(t.customer, {"a": (None, {"grp": F.col("c_mktsegment")}), "b": (None, {"grp": F.col("c_nationkey").cast("string")})})
    return flows.rows.groupBy(S.FLOW, "grp").agg(F.count(F.lit(1)).alias("n")).drop(S.FLOW)


@query("fan_out_files", """
SELECT 'rich' AS flow, c_custkey AS k, c_name AS name, NULL AS bal FROM customer WHERE c_acctbal > 5000
UNION ALL SELECT 'negative', c_custkey, NULL, c_acctbal FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'all', c_custkey, NULL, NULL FROM customer
""")
def fan_out_files(t: Tables) -> DataFrame:
    """Three outputs with columns of their own, written in one job that reads the customers once."""
    key = {"k": F.col("c_custkey")}
    flows = S.FanOut(t.customer, {
        "rich": ("c_acctbal > 5000", {**key, "name": F.col("c_name")}), "negative": (F.col("c_acctbal") < 0, {**key, "bal": F.col("c_acctbal")}), "all": (None, key),
    }).write(scratch_path(t.spark, "flows"))
    parts = [df.withColumn("flow", F.lit(name)) for name, df in flows.items()]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


@query("select_expressions", """
SELECT p_partkey, upper(p_name) || ' (' || p_brand || ')' AS title,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 2 AS DOUBLE) AS pair_price FROM part
""")
def select_expressions(t: Tables) -> DataFrame:
    return S.map_columns(
        t.part,
        {"p_partkey": "p_partkey", "title": "concat(upper(p_name), ' (', p_brand, ')')",
         "pair_price": "cast(p_retailprice as decimal(12,2)) * 2"},
        types={"pair_price": "double"},
    )
