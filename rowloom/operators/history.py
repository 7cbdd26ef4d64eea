"""Slowly changing dimension of type 2, as a DataFrame and as a stored history.

Both forms classify once: the current rows meet the source in one full join on the key, and every key
becomes new, changed, deleted or unchanged. The result is written by state, so that what follows (closing,
opening, keeping) reads only the states it needs. Keys are single on both sides, so the join has no hot key.

A stored history is a folder:

    closed/load=n    versions that load n closed, never touched again
    current/load=n   the current versions after load n
    log/load=n       one row a load, written last: a load without it has not happened

A load that fails leaves no row in the log, and the next one takes its number and its folders again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom import constants as C
from rowloom.operators.change import single_rows, with_key, without_key
from rowloom.operators.keys import surrogate_key
from rowloom.operators.shape import row_hash
from rowloom.session import materialize, scratch_path

STATE = "_state"
LOG = "load bigint, at timestamp_ntz, opened bigint, closed bigint, last_key bigint"


def _timestamp(value: dt.datetime | Column) -> Column:
    return value if isinstance(value, Column) else C.clock(value)


class _Parts(NamedTuple):
    """Current rows that stay, versions that end now, and versions that begin now."""

    kept: DataFrame
    closed: DataFrame
    opened: DataFrame


def classify(current: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """``_state`` of every key (new, changed, deleted, unchanged) with its ``old`` and ``new`` row, written by state.

    Rows are compared by the tracked columns themselves, nulls included. Both sides hold a key once; a null in
    a key matches nothing. A key that the current rows hold several times gets one row for each of them.
    """
    old = current.select(*[F.col(f"`{k}`").alias(f"_o{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in current.columns]).alias("old"))
    new = source.select(*[F.col(f"`{k}`").alias(f"_n{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("new"))
    same_key = reduce(and_, [F.col(f"_o{i}") == F.col(f"_n{i}") for i in range(len(keys))])
    equal = reduce(and_, [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in tracked], F.lit(True))
    state = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "deleted").when(equal, "unchanged").otherwise("changed")
    states = old.join(new, same_key, "full").select("old", "new", state.alias(STATE))
    path = scratch_path(current.sparkSession, "states")
    states.write.partitionBy(STATE).parquet(path)
    return current.sparkSession.read.schema(states.schema).parquet(path)


def _parts(
    current: DataFrame | None, last_key: int | Column | None, source: DataFrame, keys: list[str], now: dt.datetime, surrogate: str,
    tracked: Sequence[str], source_name: str, close_missing: bool, order_by: Sequence[str | Column] | None,
) -> _Parts:
    tracked = list(tracked) or [c for c in source.columns if c not in keys]
    hashed = materialize(source.withColumn(C.ROW_HASH, row_hash(tracked)), "snapshot")
    keyless = without_key(hashed, keys)
    single = single_rows(with_key(hashed, keys), keys, order_by)
    if current is None:
        opened, kept, closed = single.unionByName(keyless), None, None
    else:
        states = classify(current, single, keys, tracked)
        opened = states.filter(F.col(STATE).isin("new", "changed")).select("new.*").unionByName(keyless)
        ends = ["changed", "deleted"] if close_missing else ["changed"]
        ended = states.filter(F.col(STATE).isin(ends)).select("old.*")
        closed = ended.withColumns({C.VALID_TO: _timestamp(now), C.IS_CURRENT: F.lit(False)})
        stays = ["unchanged"] if close_missing else ["unchanged", "deleted"]
        kept = states.filter(F.col(STATE).isin(stays)).select("old.*")
    opened = opened.withColumns({
        C.VALID_FROM: _timestamp(now), C.VALID_TO: _timestamp(C.OPEN_END), C.IS_CURRENT: F.lit(True),
        C.LOADED_AT: _timestamp(now), C.SOURCE_NAME: F.lit(source_name),
    })
    opened = surrogate_key(opened, surrogate, keys, start=1 if last_key is None else last_key + 1)
    return _Parts(opened.limit(0) if kept is None else kept, opened.limit(0) if closed is None else closed, opened)


def scd2(
    dimension: DataFrame | None,
    source: DataFrame,
    key: str | Sequence[str],
    *,
    now: dt.datetime,
    surrogate: str,
    tracked: Sequence[str] = (),
    source_name: str = "",
    close_missing: bool = True,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """New state of a history dimension from a source snapshot.

    Current rows whose tracked columns changed, or whose key the source lacks, are closed at
    ``now``; changed and new source rows open a version that ends in 9999. A key closed
    earlier comes back as new. Rows are compared by the tracked columns themselves, nulls
    included; their hash is only stored, since unlike rows may share one. Source and current rows
    are evaluated once, into the shared folder; ``order_by`` names columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if dimension is None:
        return _parts(None, None, source, keys, now, surrogate, tracked, source_name, close_missing, order_by).opened
    last_key = dimension.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    parts = _parts(dimension.filter(C.IS_CURRENT), last_key, source, keys, now, surrogate, tracked, source_name, close_missing, order_by)
    past = dimension.filter(~F.col(C.IS_CURRENT))
    return past.unionByName(parts.kept).unionByName(parts.closed).unionByName(parts.opened, allowMissingColumns=True)


def history_log(spark: SparkSession, path: str) -> DataFrame:
    """The loads of a stored history that are complete; none where there is no history."""
    try:
        return spark.read.schema(LOG).parquet(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def load_history(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str | Sequence[str],
    *,
    now: dt.datetime,
    surrogate: str,
    tracked: Sequence[str] = (),
    source_name: str = "",
    close_missing: bool = True,
    order_by: Sequence[str | Column] | None = None,
) -> int:
    """Load a snapshot into the history stored below ``path``, by the rules of ``scd2``; gives the load's number.

    Reads the current rows and the source, never the closed versions. One load at a time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    last = history_log(spark, path).orderBy(F.desc("load")).first()
    load = last["load"] + 1 if last else 1
    current = spark.read.parquet(f"{path}/current/load={last['load']}") if last else None
    parts = _parts(current, last["last_key"] if last else None, source, keys, now, surrogate, tracked, source_name, close_missing, order_by)
    if last:
        parts.closed.write.mode("overwrite").parquet(f"{path}/closed/load={load}")
    state = parts.kept.unionByName(parts.opened, allowMissingColumns=True)
    state.write.mode("overwrite").parquet(f"{path}/current/load={load}")
    before = last["last_key"] if last else 0
    opened = spark.read.schema(state.schema).parquet(f"{path}/current/load={load}").filter(F.col(surrogate) > before)
    n, highest = opened.agg(F.count(F.lit(1)), F.coalesce(F.max(surrogate), F.lit(before))).first()
    ended = spark.read.schema(parts.closed.schema).parquet(f"{path}/closed/load={load}").count() if last else 0
    row = spark.range(1).select(F.lit(load).cast("bigint").alias("load"), C.clock(now).alias("at"), F.lit(n).cast("bigint").alias("opened"), F.lit(ended).cast("bigint").alias("closed"), F.lit(highest).cast("bigint").alias("last_key"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/load={load}")
    return load


def read_history(spark: SparkSession, path: str, load: int | None = None) -> DataFrame:
    """All versions of a stored history after its last load, or after an earlier one."""
    loads = [r["load"] for r in history_log(spark, path).select("load").collect()]
    if not loads or load is not None and load not in loads:
        raise ValueError(f"{path} has no load {load if loads else ''}".rstrip())
    load = max(loads) if load is None else load
    rows = spark.read.parquet(f"{path}/current/load={load}")
    ended = [f"{path}/closed/load={n}" for n in sorted(loads) if 1 < n <= load]
    return rows.unionByName(spark.read.option("mergeSchema", "true").parquet(*ended), allowMissingColumns=True) if ended else rows
