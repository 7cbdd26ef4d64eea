"""Catalog tables, SQL statements, inline rows and named flows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.change import action_name, apply_action, one_row_per_key, without_key
from rowloom.session import materialize

# Table formats that support MERGE.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")
VERSION = "-v"
BUCKET_ROWS = 1_000_000  # that a bucket holds on average
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_sql(spark: SparkSession, query: str, parameters: Mapping[str, object] | None = None, **views: DataFrame) -> DataFrame:
    """A query over tables and the given flows, with named parameters (``:name``)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=dict(parameters or {}))


def inline_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def generate_rows(spark: SparkSession, n: int, columns: Mapping[str, Callable[[Column], Column]], partitions: int | None = None) -> DataFrame:
    """``n`` rows made on the executors; each column is an expression of the row number."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return base.select(*[make(F.col("id")).alias(name) for name, make in columns.items()])


class FlowCache:
    """Flows kept under a name for use in several places of a job."""

    def __init__(self) -> None:
        self._flows: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
        self._flows[name] = df.persist(level)
        return self._flows[name]

    def get(self, name: str) -> DataFrame:
        return self._flows[name]

    def release(self, *names: str) -> None:
        for name in names or list(self._flows):
            self._flows.pop(name).unpersist()


def bucket_count(*tables: DataFrame, least: int = 8) -> int:
    """Buckets for tables that are joined on them: as many as the rows of the largest need, ``least`` at least.

    One task sorts and joins a bucket, so a fixed number would let its memory grow with the tables.
    """
    return max([least, *[-(-df.count() // BUCKET_ROWS) for df in tables]])


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    merge_schema: bool = True,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    path: str | None = None,
) -> None:
    """Write a table, managed or at a path. Buckets on the join key spare later joins their
    exchange.

    An append goes by column name. With ``merge_schema`` columns that the table lacks are added to the
    catalog first, and columns that the rows lack are null; without it both are errors. Values widen to the
    table's type, they never narrow.
    """
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name) and _provider(spark, name) not in ROW_LEVEL_FORMATS:
        _append_by_name(df, name, partition_by, merge_schema)
        return
    writer = df.write.format(format).mode(mode)
    if path:
        writer = writer.option("path", path)
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
    writer.saveAsTable(name)


# Types in the order in which they widen without loss.
_WIDER = ({"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3}, {"tinyint": 0, "smallint": 1, "int": 2, "double": 3}, {"float": 0, "double": 1}, {"date": 0, "timestamp_ntz": 1})


def _widens(given: T.DataType, wanted: T.DataType) -> bool:
    if given == wanted or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return given.scale <= wanted.scale and given.precision - given.scale <= wanted.precision - wanted.scale
    a, b = given.simpleString(), wanted.simpleString()
    return any(a in order and b in order and order[a] <= order[b] for order in _WIDER)


def _append_by_name(df: DataFrame, name: str, partition_by: Sequence[str], merge_schema: bool) -> None:
    spark = df.sparkSession
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partition_by and [c.lower() for c in partition_by] != [c.lower() for c in parts]:
        raise ValueError(f"{name} is partitioned by {parts}, not by {list(partition_by)}")
    table = spark.read.table(name).schema
    given = {f.name.lower(): f for f in df.schema}
    known = {f.name.lower() for f in table}
    added = [f for f in df.schema if f.name.lower() not in known]
    lacking = [f.name for f in table if f.name.lower() not in given]
    if not merge_schema and (added or lacking):
        raise ValueError(f"{name} differs in columns {sorted([f.name for f in added] + lacking)}")
    for field in table:
        mine = given.get(field.name.lower())
        if mine is not None and not _widens(mine.dataType, field.dataType):
            raise ValueError(f"column {field.name} of {name}: {mine.dataType.simpleString()} does not fit {field.dataType.simpleString()}")
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
        table = spark.read.table(name).schema
    columns = [(F.col(f"`{given[f.name.lower()].name}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in table]
    df.select(*columns).write.insertInto(name)


def save_by_load_type(df: DataFrame, name: str, full: bool, **options) -> None:
    """A full load replaces the table, others append."""
    save_table(df, name, "overwrite" if full else "append", **options)


def insert_into(df: DataFrame, name: str, overwrite_partitions: bool = False) -> None:
    """Append to a table by column name, or replace just the partitions the rows fall in, so
    that a load can be run again."""
    spark = df.sparkSession
    columns = spark.read.table(name).columns
    unknown = {c.lower() for c in df.columns} - {c.lower() for c in columns}
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    writer = df.select(*columns).write
    if not overwrite_partitions:
        writer.insertInto(name)
        return
    # tables take the mode from the session only, not from a writer option
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        writer.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def run_statement(spark: SparkSession, statement: str, parameters: Mapping[str, object] | None = None, **views: DataFrame) -> DataFrame:
    """``INSERT INTO ... SELECT`` and the like; use ``merge_table`` to update or delete."""
    return read_sql(spark, statement, parameters, **views)


def _provider(spark: SparkSession, name: str) -> str:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").first()
    return row["data_type"].lower() if row else ""


def _described(spark: SparkSession, name: str, what: str) -> str:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == what).first()
    return row["data_type"] if row else ""


def _replace(name: str, state: DataFrame) -> None:
    """Write ``state`` beside the table's files and let the table have them in one catalog step."""
    spark = state.sparkSession
    wanted = spark.read.table(name).schema
    # bucketed tables keep their layout only in Spark's own writer; a managed table goes with its first folder only
    movable = _provider(spark, name) in ("parquet", "orc") and _described(spark, name, "Type") == "EXTERNAL"
    if not movable or _described(spark, name, "Num Buckets"):
        materialize(state, "merged").write.insertInto(name, overwrite=True)
        return
    folder = f"{_base(_described(spark, name, 'Location'))}{VERSION}{uuid.uuid4().hex}"
    typed = state.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
    typed.write.format(_provider(spark, name)).save(folder)
    quoted = folder.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)


def _base(location: str) -> str:
    return re.sub(f"{VERSION}[0-9a-f]{{32}}$", "", location.rstrip("/"))


def old_versions(spark: SparkSession, name: str) -> list[str]:
    """Folders of a table's replaced states that are still there, for a clean-up after their last reader."""
    location = _described(spark, name, "Location").rstrip("/")
    base = _base(location)
    pattern = re.sub(r"([\[\]{}*?,\\])", r"\\\1", base)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    try:
        files = found.load([f"{pattern}{VERSION}*", *([base] if location != base else [])]).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    folders = files.select(F.regexp_extract("path", f"^(.*?({VERSION}[0-9a-f]{{32}})?)/part-", 1).alias("folder")).distinct()
    return sorted(r["folder"] for r in folders.collect() if _plain(r["folder"]) != _plain(location))


def _plain(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _merge_rows(name: str, source: DataFrame, keys: Sequence[str], action: str) -> None:
    """MERGE on a table format that has it: only the files with matches are rewritten."""
    source = source.alias("source")
    match = reduce(lambda a, b: a & b, [F.col(f"source.`{k}`") == F.expr(f"{name}.`{k}`") for k in keys])
    merge = source.mergeInto(name, match)
    if action in ("update", "upsert"):
        merge = merge.whenMatched().updateAll()
    if action == "upsert":
        merge = merge.whenNotMatched().insertAll()
    if action in ("delete", "delete_insert"):
        merge = merge.whenMatched().delete()
    merge.merge()
    if action == "delete_insert":
        insert_into(source, name)


def merge_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    action: str = "UPSERT",
    partition_by: str | None = None,
    order_by: Sequence[str | Column] | None = None,
    path: str | None = None,
) -> None:
    """Apply an action to a table in place; a missing table is created.

    Formats with row-level operations run a MERGE. Plain files have none. The new state of an
    unpartitioned external table (Parquet, ORC) is written to a folder of its own, once, and the catalog then takes that
    folder for the table in a single step: a job that ends before it leaves the old state, and readers
    see one of the two. The old folder stays; ``old_versions`` names it. For a table partitioned by one
    column only the partitions that hold matching keys or receive rows are read in full and rewritten,
    by way of the shared folder.
    """
    if not spark.catalog.tableExists(name):
        parts = [partition_by] if partition_by else ()
        save_table(apply_action(None, source, keys, action, order_by), name, "overwrite", parts, path=path)
        return
    target = spark.read.table(name)
    kind = action_name(action)
    if kind == "insert":
        insert_into(source, name)
        return
    if _provider(spark, name) in ROW_LEVEL_FORMATS:
        single = source if kind in ("delete", "delete_insert") else (
            one_row_per_key(source, keys, order_by).unionByName(without_key(source, keys))
        )
        _merge_rows(name, single, keys, kind)
        return
    if partition_by is None:
        _replace(name, apply_action(target, source, keys, action, order_by).select(*target.columns))
        return
    matching = target.select(*keys, partition_by).join(source.select(*keys), list(keys), "left_semi").select(partition_by)
    touching = matching if kind == "delete" else matching.unionByName(source.select(partition_by))
    # partition values are directory names: a list the driver holds for any table
    touched = [r[0] for r in touching.distinct().collect()]
    if not touched:
        return
    column = F.col(partition_by)
    inside = column.isin(*[v for v in touched if v is not None]) | (column.isNull() & F.lit(None in touched))
    state = materialize(apply_action(target.filter(inside), source, keys, action, order_by), "merged")
    filled = {r[0] for r in state.select(partition_by).distinct().collect()}
    insert_into(state, name, overwrite_partitions=True)
    for value in touched:
        if value not in filled:
            text = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value).replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{partition_by}`='{text}')")
