"""Change streams applied to keyed tables of plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowloom.operators.keys import first_per_key

BATCH = "_batch"


def stream_upsert(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    every: str | None = None,
) -> StreamingQuery:
    """Store the newest change of each key per micro-batch under ``path``.

    A batch is written to a folder named by its number and replaces it when the batch is run
    again, so a restart never applies a change twice. ``order_by`` puts the newest first.
    The cost of a batch depends on its own size, not on the size of the table; read the
    result with ``upsert_state`` and fold it now and then with ``compact``.
    """
    def apply(batch: DataFrame, number: int) -> None:
        newest = first_per_key(batch, keys, order_by)
        newest.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _batches(spark: SparkSession, path: str, base: str | None) -> DataFrame:
    """All batches; with a ``base``, its newest fold and the batches after it."""
    rows = spark.read.parquet(path)
    if base is None:
        return rows
    folds = spark.read.parquet(base)
    last = folds.agg(F.max(BATCH)).first()[0]
    return folds.filter(F.col(BATCH) == last).unionByName(rows.filter(F.col(BATCH) > last), allowMissingColumns=True)


def upsert_state(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    deleted: str | None = None,
    base: str | None = None,
) -> DataFrame:
    """Current rows: the newest change per key over all batches, without deleted keys.

    ``base`` is the target of an earlier ``compact``: batches folded there are not read again.
    """
    state = first_per_key(_batches(spark, path, base), keys, [*order_by, F.desc(BATCH)]).drop(BATCH)
    return state.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else state


def compact(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], order_by: Sequence[str | Column], base: str | None = None
) -> int:
    """Fold all batches so far into batch folder of the last one below ``target``; gives its number.

    The stream may go on writing to ``path``. The next fold takes this one as its ``base``, and goes to
    another folder or to the same one.
    """
    batches = _batches(spark, path, base)
    last = batches.agg(F.max(BATCH)).first()[0]
    if base is not None and base.rstrip("/") == target.rstrip("/") and last == spark.read.parquet(base).agg(F.max(BATCH)).first()[0]:
        return last  # nothing came after the fold
    state = first_per_key(batches, keys, [*order_by, F.desc(BATCH)]).drop(BATCH)
    state.write.mode("overwrite").parquet(f"{target}/{BATCH}={last}")
    return last
