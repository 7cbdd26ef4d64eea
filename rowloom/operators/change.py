"""Applying changes: insert, update, upsert, delete, delete-insert and SCD type 1.

Every function computes the new target as a DataFrame. With T the target and S the source:

    insert         T + S
    update         T without matches + matched T with the columns of S
    upsert         update + S without matches in T
    delete         T without matches
    delete_insert  T without matches + S

Matches use plain equality, so a null key matches nothing. The source is evaluated once, into
the shared folder, and each key is decided once, in one join. Where rows may be inserted there
are two plans, chosen by Spark's own limit for broadcasts against the size of the written source:

* within it, the source is broadcast and the target does not move at all; rows to insert are
  found from the key columns of the target;
* beyond it, both sides meet in one full join. A full join cannot be split by adaptive execution,
  so keys that hold many target rows are dealt out under a salt: their target rows over several
  tasks, their source row to each of these. A sketch over the target's key columns names them.

Updates without inserts are a left join, which Spark broadcasts or splits by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.keys import apart, first_per_key
from rowloom.session import broadcast_fits, materialize

# keys that a sketch of the target names as hot at most, and counters that it keeps
HOT_KEYS, SKETCH = 1000, 10_000

# Accepted action names.
ACTIONS = {
    "INSERT": "insert",
    "UPDATE": "update",
    "UPSERT": "upsert",
    "INSERT_OR_UPDATE": "upsert",
    "UPDATE_OR_INSERT": "upsert",
    "DELETE": "delete",
    "DELETE_INSERT": "delete_insert",
}


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def with_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.filter(_all_set(keys))


def without_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in the key: they match nothing and never compete for a key."""
    return source.filter(~_all_set(keys))


def one_row_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Source rows that have a key, one per key.

    With an order the first row wins. Without one a repeated key is an error, because which
    row would win is undefined; one job over the key columns looks for it.
    """
    keyed = with_key(source, keys)
    if order_by:
        return first_per_key(keyed, keys, order_by)
    _check_single(keyed, keys)
    return keyed


def single_rows(keyed: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """As ``one_row_per_key`` for rows that have a key, but a repeated key fails the job that reads the rows."""
    if order_by:
        return first_per_key(keyed, keys, order_by)
    seen = keyed.withColumn("_seen", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return seen.filter(F.when(F.col("_seen") > 1, F.raise_error(_repeated(keys)).cast("boolean")).otherwise(F.lit(True))).drop("_seen")


def _repeated(keys: Sequence[str | Column]) -> Column:
    return F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys)), F.lit("; give an order to choose one"))


def _check_single(keyed: DataFrame, keys: Sequence[str]) -> None:
    """An error when a key repeats."""
    per_key = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = per_key.filter("_n > 1").drop("_n").first()
    if repeated is not None:
        raise ValueError(f"several source rows for key {repeated.asDict()}; give an order to choose one")


class _Changes:
    """Source rows, evaluated once, with what they do to a target."""

    def __init__(
        self,
        source: DataFrame,
        keys: Sequence[str],
        order_by: Sequence[str | Column] | None = None,
        columns: Sequence[str] | None = None,
        removed: Column | None = None,
    ) -> None:
        self.keys = list(keys)
        self.columns = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
        flag = F.lit(False) if removed is None else F.coalesce(removed, F.lit(False))
        # a written 0 is a join key like any other; a literal would be folded away, and null keys meet in one task
        self.source = materialize(source.withColumns({"_removed": flag, "_ks": F.lit(0)}), "changes")
        # an order has picked one row per key; otherwise repeated keys are found where the rows meet
        self.single = bool(order_by)
        self.keyed = first_per_key(with_key(self.source, keys), keys, order_by) if order_by else with_key(self.source, keys)

    def _rows(self, keyed: DataFrame) -> DataFrame:
        """Keys ``_k``, values ``_n``, ``_salt`` and ``_hit``, which fails when a key repeats."""
        rows = keyed.select(
            *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.keys)],
            *[F.col(f"`{c}`").alias(f"_n{i}") for i, c in enumerate(self.columns)],
            "_removed", *[c for c in ("_ks", "_known") if c in keyed.columns],
        )
        names = [f"_k{i}" for i in range(len(self.keys))]
        if self.single:
            return rows.withColumn("_hit", F.lit(True))
        message = _repeated([F.col(n).alias(k) for n, k in zip(names, self.keys, strict=True)])
        # partitioned as the join wants it
        seen = F.count(F.lit(1)).over(Window.partitionBy(*names, "_ks"))
        return rows.withColumn("_hit", F.when(seen > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))

    def _match(self, other: DataFrame, rows: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [other[f"`{k}`"] == rows[f"_k{i}"] for i, k in enumerate(self.keys)])

    def _values(self, target: DataFrame) -> list[Column]:
        """Target columns of a matched pair or a row of the target alone."""
        value = {c: F.col(f"_n{i}") for i, c in enumerate(self.columns)}
        return [F.when(F.col("_hit"), value[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in value else F.col(f"`{c}`") for c in target.columns]

    def _keyless(self) -> DataFrame:
        return without_key(self.source, self.keys).filter("NOT _removed").select(*[F.col(f"`{c}`") for c in [*self.keys, *self.columns]])

    def updated(self, target: DataFrame) -> DataFrame:
        """All target rows; matched ones with the source values, or gone where removed."""
        rows = self._rows(self.keyed)
        rows = rows.select(*[apart(f"_k{i}").alias(f"_k{i}") for i in range(len(self.keys))], *rows.columns[len(self.keys) :])
        joined = target.join(rows, self._match(target, rows), "left")
        return joined.filter(~F.coalesce(F.col("_removed"), F.lit(False))).select(*self._values(target))

    def applied(self, target: DataFrame) -> DataFrame:
        """As ``updated``, with the source rows that the target lacks and those without a key."""
        if broadcast_fits(self.source):
            return self.updated(target).unionByName(self._inserted(target), allowMissingColumns=True)
        return self._met(target).unionByName(self._keyless(), allowMissingColumns=True)

    def _inserted(self, target: DataFrame) -> DataFrame:
        rows = self._rows(self.keyed)
        known = target.select(*[F.col(f"`{k}`") for k in self.keys])
        known = known.join(F.broadcast(rows.select(*[f"_k{i}" for i in range(len(self.keys))])), self._match(known, rows), "left_semi").distinct()
        fresh = rows.join(known, self._match(known, rows), "left_anti").filter("NOT _removed")
        named = fresh.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(self.keys)], *[F.col(f"_n{i}").alias(c) for i, c in enumerate(self.columns)])
        return named.unionByName(self._keyless())

    def _met(self, target: DataFrame) -> DataFrame:
        """Both sides in one full join on keys and salt."""
        tasks = 2 * int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_keys(target, self.keys, tasks)
        place = F.monotonically_increasing_id()
        keyless = F.when(~_all_set(self.keys), F.pmod(place, F.lit(tasks)))
        left, right, copies = target, self.keyed.withColumn("_known", F.lit(False)), F.lit(0)
        if hot is not None:
            copies = F.coalesce("_copies", F.lit(0))
            left = _beside(target, hot, self.keys)
            # salted copies stand for a key that the target has: none of them is ever inserted
            right = _beside(self.keyed, hot, self.keys).withColumn("_known", copies > 0)
            right = right.withColumn("_ks", F.explode(F.sequence(F.lit(0), F.greatest(copies - 1, F.lit(0)))))
        salt = F.coalesce(keyless, F.when(copies > 0, F.pmod(place, copies)), F.lit(0)).cast("int")
        left = left.withColumns({"_salt": salt, "_own": F.lit(True)}).drop("_copies")
        rows = self._rows(right)
        joined = left.join(rows, self._match(left, rows) & (F.col("_salt") == F.col("_ks")), "full")
        joined = joined.filter(~F.coalesce(F.col("_removed"), F.lit(False)) & (F.col("_own") | ~F.col("_known")))
        keys = {k: F.coalesce(F.col(f"`{k}`"), F.col(f"_k{i}")).alias(k) for i, k in enumerate(self.keys)}
        return joined.select(*[keys.get(c, v) for c, v in zip(target.columns, self._values(target), strict=True)])


def hot_keys(target: DataFrame, keys: Sequence[str], tasks: int) -> DataFrame | None:
    """Keys with more than a share of 1 / ``tasks`` of the rows, and over how many tasks to deal them (``_copies``).

    A sketch with a bounded number of counters finds hashes that may be hot; only if there are any, their
    keys are counted. Which keys it names alters the plan, not the result. None if there are none.
    """
    named = target.filter(_all_set(keys)).select(*[F.col(f"`{k}`") for k in keys])
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    found = named.select(hashed.alias("h")).agg(F.expr(f"approx_top_k(h, {min(tasks, HOT_KEYS)}, {SKETCH})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    hashes = [x["item"] for x in found["top"] or [] if x["count"] * tasks > found["n"]]
    if not hashes:
        return None
    counted = named.filter(hashed.isin(hashes)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    copies = F.least(F.ceil(F.col("_n") * tasks / F.lit(found["n"])), F.lit(tasks)).cast("int")
    return materialize(counted.select(*[F.col(f"`{k}`").alias(f"_h{i}") for i, k in enumerate(keys)], copies.alias("_copies")), "hot-keys")


def _beside(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``_copies``; at most ``HOT_KEYS`` rows are broadcast, save for hashes that clash."""
    match = reduce(lambda a, b: a & b, [df[f"`{k}`"] == hot[f"_h{i}"] for i, k in enumerate(keys)])
    return df.join(F.broadcast(hot), match, "left").drop(*[f"_h{i}" for i in range(len(keys))])


def _unmatched(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(other.select(*keys), list(keys), "left_anti").select(*rows.columns)


def _check_columns(target: DataFrame, source: DataFrame) -> None:
    if set(target.columns) != set(source.columns):
        odd = sorted(set(target.columns) ^ set(source.columns))
        raise ValueError(f"source and target differ in columns {odd}")


def insert(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def update(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    _check_columns(target, source)
    return _Changes(source, keys, order_by).updated(target)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    _check_columns(target, source)
    return _Changes(source, keys, order_by).applied(target)


def delete(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _unmatched(target, source, keys)


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace matched rows by all source rows, as one new state."""
    source = materialize(source, "changes")
    return _unmatched(target, source, keys).unionByName(source, allowMissingColumns=True)


def scd1(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    """Overwrite the attributes the source has; columns only the target has are kept, and
    are null in inserted rows."""
    extra = sorted(set(source.columns) - set(target.columns))
    if extra:
        raise ValueError(f"target lacks columns {extra}")
    return _Changes(source, keys, order_by).applied(target)


def action_name(action: str) -> str:
    if action.upper() not in ACTIONS:
        raise ValueError(f"unknown action {action!r}, use one of {sorted(ACTIONS)}")
    return ACTIONS[action.upper()]


def apply_action(target: DataFrame | None, source: DataFrame, keys: Sequence[str], action: str, order_by=None) -> DataFrame:
    """Run the named action (any case). Without a target the source becomes the target."""
    name = action_name(action)
    if target is None:
        if name in ("update", "delete"):
            return source.limit(0)
        if name in ("insert", "delete_insert"):
            return source
        return one_row_per_key(source, keys, order_by).unionByName(without_key(source, keys))
    if name == "insert":
        return insert(target, source)
    if name == "update":
        return update(target, source, keys, order_by)
    if name == "upsert":
        return upsert(target, source, keys, order_by)
    if name == "delete":
        return delete(target, source, keys)
    return delete_insert(target, source, keys)


def apply_deletes(target: DataFrame, source: DataFrame, keys: Sequence[str], deleted: str | Column, order_by=None) -> DataFrame:
    """Upsert the live source rows and remove the keys flagged as deleted, in one join.

    A key that is flagged and that the target lacks stays away."""
    flag = F.col(deleted) if isinstance(deleted, str) else deleted
    return _Changes(source, keys, order_by, [c for c in target.columns if c not in keys], flag).applied(target)
