"""Databases over JDBC. The driver jars are the caller's to provide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from rowloom import constants as C

# Driver class and URL form of each vendor.
VENDORS: dict[str, tuple[str, str]] = {
    "oracle": ("oracle.jdbc.OracleDriver", "jdbc:oracle:thin:@//{host}:{port}/{database}"),
    "postgresql": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
    "sqlserver": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://{host}:{port};databaseName={database}"),
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}"),
    "db2": ("com.ibm.db2.jcc.DB2Driver", "jdbc:db2://{host}:{port}/{database}"),
    "as400": ("com.ibm.as400.access.AS400JDBCDriver", "jdbc:as400://{host};libraries={database}"),
    "teradata": ("com.teradata.jdbc.TeraDriver", "jdbc:teradata://{host}/DBS_PORT={port},DATABASE={database}"),
    "sybase": ("com.sybase.jdbc4.jdbc.SybDriver", "jdbc:sybase:Tds:{host}:{port}/{database}"),
    "redshift": ("com.amazon.redshift.jdbc42.Driver", "jdbc:redshift://{host}:{port}/{database}"),
    "sqlite": ("org.sqlite.JDBC", "jdbc:sqlite:{database}"),
    "informix": ("com.informix.jdbc.IfxDriver", "jdbc:informix-sqli://{host}:{port}/{database}"),
    "vertica": ("com.vertica.jdbc.Driver", "jdbc:vertica://{host}:{port}/{database}"),
    "netezza": ("org.netezza.Driver", "jdbc:netezza://{host}:{port}/{database}"),
    "greenplum": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
    "saphana": ("com.sap.db.jdbc.Driver", "jdbc:sap://{host}:{port}/?databaseName={database}"),
    "impala": ("com.cloudera.impala.jdbc.Driver", "jdbc:impala://{host}:{port}/{database}"),
    "hive": ("org.apache.hive.jdbc.HiveDriver", "jdbc:hive2://{host}:{port}/{database}"),
}


def connection(vendor: str, database: str, host: str = "", port: int | str = "", **properties: object) -> dict[str, str]:
    """Reader and writer options for a vendor; ``properties`` hold user, password and the like."""
    if vendor not in VENDORS:
        raise ValueError(f"unknown vendor {vendor!r}, use one of {sorted(VENDORS)} or give url and driver yourself")
    driver, url = VENDORS[vendor]
    return {"url": url.format(host=host, port=port, database=database), "driver": driver,
            **{k: str(v) for k, v in properties.items()}}


def _reader(spark: SparkSession, options: Mapping[str, str], source: Mapping[str, str], fetch: int) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options, **source, fetchsize=fetch)


def read_options(
    table: str | None = None,
    query: str | None = None,
    split_by: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """What to read: a table, or a query (as a derived table, so that it can be split too).

    ``split_by`` with bounds reads in parallel; the bounds set the stride, rows outside
    them are still read.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    chosen = {"dbtable": table if table is not None else f"({query.strip().rstrip(';')}) q"}
    if split_by is None:
        return chosen
    if bounds is None:
        raise ValueError("a split column needs bounds; see column_bounds")
    return {**chosen, "partitionColumn": split_by, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions)}


def read_database(spark: SparkSession, options: Mapping[str, str], *, fetch: int = C.JDBC_BATCH_SIZE, **source: object) -> DataFrame:
    """Filters and columns used later are pushed into the source by Spark."""
    return _reader(spark, options, read_options(**source), fetch).load()


def read_since(
    spark: SparkSession, options: Mapping[str, str], table: str, column: str, since: str | None, **source: object
) -> DataFrame:
    """The whole table, or the rows from a date on; the filter runs in the source."""
    df = read_database(spark, options, table=table, **source)
    return df if since is None else df.filter(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))


def column_bounds(spark: SparkSession, options: Mapping[str, str], table: str, column: str) -> tuple[object, object]:
    """Least and greatest value of a column, read by one aggregate query in the source."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    low, high = read_database(spark, options, query=query).first()
    return low, high


def import_table(spark: SparkSession, options: Mapping[str, str], table: str, path: str, split_by: str, partitions: int) -> None:
    """Copy a database table to parquet in parallel."""
    bounds = column_bounds(spark, options, table, split_by)
    df = read_database(spark, options, table=table, split_by=split_by, bounds=bounds, partitions=partitions)
    df.write.mode("overwrite").parquet(path)


def write_options(batch: int = C.JDBC_BATCH_SIZE, connections: int | None = None, isolation: str = "READ_COMMITTED", truncate: bool = False) -> dict[str, str]:
    """Rows per round trip, at most so many connections, and how an overwrite empties the table."""
    chosen = {"batchsize": str(batch), "isolationLevel": isolation, "truncate": str(truncate).lower()}
    return {**chosen, "numPartitions": str(connections)} if connections else chosen


def _writer(df: DataFrame, options: Mapping[str, str], table: str, mode: str, **how: object) -> DataFrameWriter:
    return df.write.format("jdbc").mode(mode).options(**options, dbtable=table, **write_options(**how))


def write_database(df: DataFrame, options: Mapping[str, str], table: str, mode: str = "append", **how: object) -> None:
    _writer(df, options, table, mode, **how).save()


def export_table(df: DataFrame, options: Mapping[str, str], table: str, connections: int, batch: int = C.JDBC_BATCH_SIZE) -> None:
    """Bulk load: large batches over a stated number of connections, no isolation between them."""
    write_database(df, options, table, "append", batch=batch, connections=connections, isolation="NONE")


def primary_columns(columns: Sequence[Mapping[str, object]]) -> list[str]:
    """Names of the key columns of a column spec."""
    return [str(c["name"]) for c in columns if c.get("key")]
