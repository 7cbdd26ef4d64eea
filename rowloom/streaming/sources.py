"""Streaming inputs and outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def topic_options(servers: str, topic: str, start: str = "earliest", **options: object) -> dict[str, str]:
    """Options of a message topic (Kafka protocol)."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
            **{k: str(v) for k, v in options.items()}}


def read_topic(spark: SparkSession, options: Mapping[str, str], schema: str | T.StructType | None = None) -> DataFrame:
    """Messages of a topic; with a schema the JSON value becomes columns."""
    messages = spark.readStream.format("kafka").options(**options).load()
    text = messages.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
    if schema is None:
        return text
    return text.select("key", "timestamp", F.from_json("value", schema).alias("v")).select("key", "timestamp", "v.*")


def read_file_stream(
    spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "parquet", files_per_batch: int | None = None, **options: object
) -> DataFrame:
    """New files of a folder (or glob) as a stream."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def write_file_stream(df: DataFrame, path: str, checkpoint: str, kind: str = "parquet", every: str | None = None) -> StreamingQuery:
    """Append to files. Without ``every`` the query takes what is there now and stops."""
    writer = df.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def write_topic(df: DataFrame, options: Mapping[str, str], topic: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    """Rows as JSON messages."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")
    messages = df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)
    return (
        messages.writeStream.format("kafka").options(**options).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


def load_available(df: DataFrame, path: str, checkpoint: str, kind: str = "parquet") -> StreamingQuery:
    """Incremental load: each run takes the files that came since the last one, then ends."""
    query = write_file_stream(df, path, checkpoint, kind)
    query.awaitTermination()
    return query
