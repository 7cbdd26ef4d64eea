"""File formats: tables written by Spark in a format and read back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.quality import compare_files
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.sources import connectors, files
from rowloom.sources import tables as TB

_PARTS = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
_PART_SQL = "SELECT * FROM part"


@query("format_csv", _PART_SQL)
def format_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_delimited(t.part, path, separator=";", header=True)
    return files.read_delimited(t.spark, path, _PARTS, separator=";", header=True)


@query("format_encoding", _PART_SQL.replace("*", "p_partkey, p_name || 'é' AS p_name"))
def format_encoding(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "latin")
    accented = t.part.select("p_partkey", F.concat("p_name", F.lit("é")).alias("p_name"))
    files.write_delimited(accented, path, encoding="ISO-8859-1")
    return files.read_delimited(t.spark, path, "p_partkey bigint, p_name string", encoding="ISO-8859-1")


@query("format_csv_rejects", "SELECT c_custkey, c_name || ',' || c_mktsegment AS line FROM customer WHERE c_acctbal < 0")
def format_csv_rejects(t: Tables) -> DataFrame:
    """Lines with text where the schema wants a number are rejects."""
    path = scratch_path(t.spark, "badcsv")
    key = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string"))
    t.customer.select(F.concat_ws(",", key, "c_name", "c_mktsegment").alias("value")).write.text(path)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_mktsegment string")
    bad = files.delimited_flows(t.spark, path, schema).rejected
    return bad.select(
        F.regexp_extract("_bad_row", "^x([0-9]+),", 1).cast("bigint").alias("c_custkey"), F.regexp_extract("_bad_row", "^[^,]*,(.*)$", 1).alias("line")
    )


@query("format_json", _PART_SQL)
def format_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    files.write_files(t.part, path, "json")
    return files.read_json(t.spark, path, _PARTS)


@query("format_parquet", "SELECT * FROM orders")
def format_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    files.write_files(t.orders, path, partition_by=["o_orderstatus"])
    return files.read_parquet(t.spark, path, t.orders.schema)


@query("format_orc", _PART_SQL)
def format_orc(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orc")
    files.write_files(t.part, path, "orc")
    return files.read_orc(t.spark, path)


@query("format_xml", _PART_SQL)
def format_xml(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "xml")
    files.write_xml(t.part, path, "parts", "part")
    return files.read_xml(t.spark, path, "part", _PARTS)


@query("format_xml_nested", """
SELECT l_orderkey AS order_id, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY l_orderkey
""")
def format_xml_nested(t: Tables) -> DataFrame:
    """One element per order with its lines inside; an order has a handful of lines."""
    path = scratch_path(t.spark, "tree")
    line = F.struct(F.col("l_linenumber").alias("no"), F.col("l_quantity").alias("quantity"))
    nested = t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.collect_list(line).alias("line"))
    files.write_xml(nested, path, "orders", "order")
    read = files.read_xml(t.spark, path, "order", "order_id bigint, line array<struct<no:int,quantity:double>>")
    return read.select(
        "order_id", F.size("line").cast("bigint").alias("lines"), F.aggregate("line", F.lit(0.0), lambda a, x: a + x["quantity"]).alias("quantity")
    )


_WIDTHS = [("c_custkey", 12, "right"), ("c_name", 20, "left"), ("c_nationkey", 4, "right"), ("c_acctbal", 12, "right"), ("c_mktsegment", 10, "left")]


@query("fixed_width", "SELECT * FROM customer")
def fixed_width(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "fixed")
    files.write_fixed_width(t.customer, path, _WIDTHS)
    kinds = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    return files.read_fixed_width(t.spark, path, [(n, w, kinds.get(n, "string")) for n, w, _ in _WIDTHS])


def _log(t: Tables) -> str:
    path = scratch_path(t.spark, "log")
    line = F.format_string("[%s] user=%d event=%d", "event_type", "user_id", "event_id")
    t.events.select(F.when(F.col("event_type") == "error", F.concat(F.lit("?? "), line)).otherwise(line).alias("value")).write.text(path)
    return path


_FIELDS = {"event_type": "string", "user_id": "bigint", "event_id": "bigint"}
_LINE = r"^\[(\w+)\] user=(\d+) event=(\d+)$"


@query("regex_lines", "SELECT event_type, user_id, event_id FROM events WHERE event_type <> 'error'")
def regex_lines(t: Tables) -> DataFrame:
    return files.read_regex(t.spark, _log(t), _LINE, _FIELDS).accepted


@query("regex_lines_rejects", "SELECT '?? [error] user=' || user_id || ' event=' || event_id AS line FROM events WHERE event_type = 'error'")
def regex_lines_rejects(t: Tables) -> DataFrame:
    return files.read_regex(t.spark, _log(t), _LINE, _FIELDS).rejected


@query("full_row_text", "SELECT unnest(string_split(text, chr(10))) AS line FROM conversations")
def full_row_text(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lines")
    t.conversations.select("text").write.text(path)
    return files.read_lines(t.spark, path)


@query("directory_entries", """
SELECT c_custkey, c_name AS cn, c_mktsegment AS segment, CAST(2 AS BIGINT) AS classes FROM customer
""")
def directory_entries(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "entries")
    block = F.concat(
        F.lit("dn: uid="), F.col("c_custkey").cast("string"), F.lit(",o=customers\nobjectClass: top\nobjectClass: party\ncn: "), F.col("c_name"),
        F.lit("\nsegment: "), F.substring("c_mktsegment", 1, 3), F.lit("\n "), F.col("c_mktsegment").substr(F.lit(4), F.lit(99)), F.lit("\n"),
    )
    t.customer.select(block.alias("value")).write.text(path)
    entries = files.read_entries(t.spark, path, ["dn", "objectClass", "cn", "segment"])
    return entries.select(
        F.regexp_extract(F.get("dn", F.lit(0)), "uid=([0-9]+)", 1).cast("bigint").alias("c_custkey"), F.get("cn", F.lit(0)).alias("cn"),
        F.get("segment", F.lit(0)).alias("segment"), F.size("objectClass").cast("bigint").alias("classes"),
    )


@query("raw_binary", "SELECT page_id, url, octet_length(encode(html)) AS bytes FROM pages")
def raw_binary(t: Tables) -> DataFrame:
    """Bytes kept through a binary column, counted after reading back."""
    path = scratch_path(t.spark, "bytes")
    files.write_files(t.pages.select("page_id", "url", F.encode("html", "UTF-8").alias("content")), path)
    return files.read_parquet(t.spark, path).select("page_id", "url", F.octet_length("content").cast("bigint").alias("bytes"))


@query("file_manifest", "SELECT DISTINCT o_orderstatus, true AS filled FROM orders")
def file_manifest(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    files.write_files(t.orders, path, partition_by=["o_orderstatus"])
    listed = files.file_manifest(t.spark, path, "*.parquet")
    status = F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("o_orderstatus")
    return listed.groupBy(status).agg((F.sum("length") > 0).alias("filled"))


@query("file_compare", "SELECT DISTINCT o_orderstatus, 'same' AS state FROM orders")
def file_compare(t: Tables) -> DataFrame:
    """Two exports of the same rows, one file per state, compared through their content hash."""
    paths = [scratch_path(t.spark, "export") for _ in range(2)]
    summary = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))
    for path in paths:
        summary.write.partitionBy("o_orderstatus").json(path)
    # part file names differ between runs, so a file is named by its folder
    compared = compare_files(t.spark, *paths, name=F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1))
    return compared.withColumnRenamed("file", "o_orderstatus")


@query("connector_registry", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def connector_registry(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sink")
    connectors.write_sink(t.nation, "orc", path=path)
    return connectors.read_source(t.spark, "orc", path=path)


@query("generated_rows", "SELECT o_orderkey AS id, o_orderkey % 7 AS bucket FROM orders")
def generated_rows(t: Tables) -> DataFrame:
    """As many generated rows as there are orders."""
    n = t.orders.count()
    return TB.generate_rows(t.spark, n, {"id": lambda i: i, "bucket": lambda i: i % 7})


@query("cached_flow", """
SELECT s_suppkey, s_name, n FROM supplier JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey
""")
def cached_flow(t: Tables) -> DataFrame:
    cache = TB.FlowCache()
    cache.put("suppliers", t.supplier.select("s_suppkey", "s_name"))
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    return cache.get("suppliers").join(lines, "s_suppkey")
