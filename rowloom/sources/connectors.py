"""One way to reach the data sources that come as Spark packages."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Connector(NamedTuple):
    """Spark format name, whether Spark itself has it, and the options a caller must give."""

    format: str
    built_in: bool
    required: tuple[str, ...] = ()


# Format names of the data sources.
CONNECTORS: dict[str, Connector] = {
    "csv": Connector("csv", True),
    "json": Connector("json", True),
    "parquet": Connector("parquet", True),
    "orc": Connector("orc", True),
    "text": Connector("text", True),
    "xml": Connector("xml", True, ("rowTag",)),
    "binary": Connector("binaryFile", True),
    "jdbc": Connector("jdbc", True, ("url",)),
    "avro": Connector("avro", False),
    "excel": Connector("com.crealytics.spark.excel", False),
    "delta": Connector("delta", False),
    "snowflake": Connector("snowflake", False, ("sfUrl", "dbtable")),
    "mongodb": Connector("mongodb", False, ("connection.uri", "database", "collection")),
    "cassandra": Connector("org.apache.spark.sql.cassandra", False, ("keyspace", "table")),
    "cosmosdb": Connector("cosmos.oltp", False, ("spark.cosmos.accountEndpoint", "spark.cosmos.container")),
    "elasticsearch": Connector("org.elasticsearch.spark.sql", False, ("es.resource",)),
    "hbase": Connector("org.apache.hadoop.hbase.spark", False, ("hbase.table",)),
    "kafka": Connector("kafka", False, ("kafka.bootstrap.servers",)),
}


class MissingConnector(RuntimeError):
    """The session lacks the package of a connector."""


def _connector(kind: str, options: Mapping[str, object]) -> Connector:
    if kind not in CONNECTORS:
        raise ValueError(f"unknown connector {kind!r}, use one of {sorted(CONNECTORS)}")
    connector = CONNECTORS[kind]
    absent = [o for o in connector.required if o not in options]
    if absent:
        raise ValueError(f"connector {kind!r} needs the options {absent}")
    return connector


def _guard(kind: str, connector: Connector, error: Exception) -> Exception:
    text = str(error)
    if not connector.built_in and ("DATA_SOURCE_NOT_FOUND" in text or "Failed to find" in text or "ClassNotFound" in text):
        return MissingConnector(f"{kind}: add the package that provides the format {connector.format!r} to the session")
    return error


def read_source(spark: SparkSession, kind: str, options: Mapping[str, object] | None = None, path: str | None = None, schema=None) -> DataFrame:
    options = dict(options or {})
    connector = _connector(kind, options)
    reader = spark.read.format(connector.format).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path) if path else reader.load()
    except Exception as error:
        raise _guard(kind, connector, error) from error


def write_sink(df: DataFrame, kind: str, options: Mapping[str, object] | None = None, path: str | None = None, mode: str = "append") -> None:
    options = dict(options or {})
    connector = _connector(kind, options)
    writer = df.write.format(connector.format).mode(mode).options(**{k: str(v) for k, v in options.items()})
    try:
        writer.save(path) if path else writer.save()
    except Exception as error:
        raise _guard(kind, connector, error) from error
