"""File formats. Paths may be local or on any store Hadoop knows (s3a, abfss, wasbs, gs, hdfs)."""

from __future__ import annotations

import codecs
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.flows import Flows
from rowloom.operators.shape import regex_fields

Schema = str | T.StructType
XML_ROWS = 100_000  # of a written XML file, which Spark reads in one task


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    *,
    separator: str = ",",
    header: bool = False,
    encoding: str = "UTF-8",
    **options: object,
) -> DataFrame:
    """CSV and the like. Give a schema: inferring one costs a pass over all files."""
    reader = spark.read.options(sep=separator, header=header, encoding=encoding, **options)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def delimited_flows(
    spark: SparkSession, path: str, schema: T.StructType, *, separator: str = ",", header: bool = False, **options: object
) -> Flows:
    """CSV rows that fit the schema, and the text of those that do not."""
    bad = "_bad_row"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    rows = spark.read.options(
        sep=separator, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, **options
    ).schema(wide).csv(path)
    # Spark refuses to read the bad text alone, so it is tied to the other columns
    text = F.coalesce(F.col(bad), F.concat_ws(separator, *[F.col(f"`{c}`").cast("string") for c in schema.names]))
    rejected = rows.filter(F.col(bad).isNotNull()).select(*schema.names, text.alias(bad))
    return Flows(rows.filter(F.col(bad).isNull()).drop(bad), rejected)


def read_json(spark: SparkSession, path: str, schema: Schema | None = None, multiline: bool = False, **options: object) -> DataFrame:
    reader = spark.read.options(multiLine=multiline, **options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_orc(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).orc(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: Schema | None = None, **options: object) -> DataFrame:
    reader = spark.read.format("xml").options(rowTag=row_tag, **options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_lines(spark: SparkSession, path: str, name: str = "line", encoding: str | None = None) -> DataFrame:
    """One row per line, blank lines included. Lines are cut as bytes and decoded one by one, so the
    charset must keep ASCII line ends: UTF-16 and UTF-32 are refused."""
    lines = spark.read.text(path)
    charset = codecs.lookup(encoding or "utf-8").name
    if charset.startswith(("utf-16", "utf-32")):
        raise ValueError(f"lines cannot be cut in {encoding}, convert the file first")
    if charset == "utf-8":
        return lines.select(F.col("value").alias(name))
    if charset in ("ascii", "iso8859-1"):
        return lines.select(F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias(name))

    def decoded(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else v.decode(charset, "replace") for v in values.to_pylist()], pa.string())

    return lines.select(F.arrow_udf(decoded, "string")(F.col("value").cast("binary")).alias(name))


def read_fixed_width(spark: SparkSession, path: str, fields: Sequence[tuple[str, int, str]], trim: bool = True) -> DataFrame:
    """Lines cut at fixed places; ``fields`` are (name, width, type) in order."""
    columns, start = [], 1
    for name, width, kind in fields:
        text = F.substring("value", start, width)
        columns.append((F.trim(text) if trim else text).try_cast(kind).alias(name))
        start += width
    return spark.read.text(path).select(*columns)


def read_regex(spark: SparkSession, path: str, pattern: str, fields: Mapping[str, str]) -> Flows:
    """Lines that match a pattern, as the typed groups; the other lines are rejects."""
    flows = regex_fields(spark.read.text(path), "value", pattern, fields)
    return Flows(flows.accepted.drop("value"), flows.rejected.withColumnRenamed("value", "line"))


def read_entries(spark: SparkSession, path: str, attributes: Sequence[str], separator: str | None = None) -> DataFrame:
    """Directory export (LDIF): blocks of ``name: value`` lines split by a blank line.

    Folded lines are joined, comments dropped, ``name:: value`` decoded from base64; a repeated
    attribute gives an array. Without a ``separator`` the first line tells whether lines end in
    CR LF; files of the other kind in the same folder are cut as well, each after it was read whole.
    """
    if separator is None:
        first = spark.read.option("lineSep", "\n").text(path).first()
        separator = "\r\n\r\n" if first and first[0].endswith("\r") else "\n\n"
    blocks = spark.read.option("lineSep", separator).text(path)
    blocks = blocks.select(F.explode(F.split("value", r"\r?\n\r?\n")).alias("value"))
    lines = F.split(F.replace(F.regexp_replace("value", "\r", ""), F.lit("\n "), F.lit("")), "\n")
    lines = F.filter(lines, lambda x: x.rlike(r"^[^#\s][^:]*:"))
    blocks = blocks.select(lines.alias("lines")).filter(F.size("lines") > 0)

    def values(name: str) -> Column:
        mine = F.filter("lines", lambda x: F.lower(F.substring_index(x, ":", 1)) == name.lower())
        text = F.transform(mine, lambda x: F.substring(x, F.lit(len(name) + 2), F.length(x)))

        def plain(x: Column) -> Column:
            coded = F.unbase64(F.trim(F.substring(x, F.lit(2), F.length(x)))).cast("string")
            return F.when(x.startswith(":"), coded).otherwise(F.trim(x))

        return F.transform(text, plain).alias(name)

    return blocks.select(*[values(a) for a in attributes])


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, size and time of the files below a folder; contents are not read."""
    return read_binary(spark, path, glob).select("path", "length", "modificationTime")


def write_files(
    df: DataFrame,
    path: str,
    kind: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    max_rows_per_file: int = 0,
    **options: object,
) -> None:
    """csv, json, parquet, orc or xml."""
    writer = df.write.format(kind).mode(mode).options(**options)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_delimited(df: DataFrame, path: str, separator: str = ",", header: bool = False, encoding: str = "UTF-8", mode: str = "errorifexists", **options: object) -> None:
    write_files(df, path, "csv", mode, sep=separator, header=header, encoding=encoding, **options)


def write_xml(
    df: DataFrame, path: str, root_tag: str, row_tag: str, mode: str = "errorifexists", max_rows_per_file: int | None = None, **options: object
) -> None:
    """Nested output comes from struct and array columns.

    Spark cannot cut an XML file for reading, so a file holds at most ``max_rows_per_file`` elements, ``XML_ROWS``
    if not given; 0 sets no bound. Give less for elements of many kilobytes.
    """
    most = XML_ROWS if max_rows_per_file is None else max_rows_per_file
    write_files(df, path, "xml", mode, max_rows_per_file=most, rootTag=root_tag, rowTag=row_tag, **options)


def fixed_width_line(fields: Sequence[tuple[str, int, str]]) -> Column:
    """Line text for (name, width, side), padded on the other side. A value that is too long raises an error."""
    cells = []
    for name, width, side in fields:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        long = F.concat(F.lit(f"{name} is longer than {width} characters: "), text)
        text = F.when(F.length(text) > width, F.raise_error(long).cast("string")).otherwise(text)
        cells.append(F.lpad(text, width, " ") if side == "right" else F.rpad(text, width, " "))
    return F.concat(*cells)


def write_fixed_width(df: DataFrame, path: str, fields: Sequence[tuple[str, int, str]], mode: str = "errorifexists") -> None:
    df.select(fixed_width_line(fields).alias("value")).write.mode(mode).text(path)
