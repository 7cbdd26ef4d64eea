"""Checks that compare tables, and checks on single rows."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import constants as C
from rowloom.flows import Flows
from rowloom.operators.aggregate import unique_flows
from rowloom.operators.shape import holds, sample_rows
from rowloom.session import materialize

COUNT_SCHEMA = "entity string, source_row_count bigint, target_row_count bigint, threshold_pct double"


def not_null_flows(df: DataFrame, columns: Sequence[str]) -> Flows:
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))
    return Flows(df.filter(present), df.filter(~present))


def check_rules(df: DataFrame, rules: Mapping[str, Column | str], reasons: str = "reasons") -> Flows:
    """Rows that pass every rule, and the others with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()]), lambda r: r.isNotNull()
    )
    checked = df.withColumn(reasons, broken)
    return Flows(
        checked.filter(F.size(reasons) == 0).drop(reasons),
        checked.filter(F.size(reasons) > 0),
    )


def pattern_flows(df: DataFrame, column: str, pattern: str) -> Flows:
    hit = holds(F.col(column).rlike(pattern))
    return Flows(df.filter(hit), df.filter(~hit))


def compliance_rules(spec: Sequence[Mapping[str, object]]) -> dict[str, Column]:
    """Rules of a column spec: ``name`` and any of ``type``, ``length``, ``nullable``,
    ``pattern``, ``values``. Only nullability looks at nulls."""
    rules: dict[str, Column] = {}
    for column in spec:
        name = column["name"]
        value = F.col(f"`{name}`")
        empty = value.isNull()
        if column.get("nullable") is False:
            rules[f"{name}:null"] = ~empty
        if column.get("type"):
            rules[f"{name}:type"] = empty | value.try_cast(str(column["type"])).isNotNull()
        if column.get("length") is not None:
            rules[f"{name}:length"] = empty | (F.length(value.cast("string")) <= int(column["length"]))
        if column.get("pattern"):
            rules[f"{name}:pattern"] = empty | value.cast("string").rlike(str(column["pattern"]))
        if column.get("values"):
            rules[f"{name}:values"] = empty | value.isin(*column["values"])
    return rules


def schema_compliance(df: DataFrame, spec: Sequence[Mapping[str, object]], reasons: str = "reasons") -> Flows:
    return check_rules(df, compliance_rules(spec), reasons)


def unique_check(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> Flows:
    return unique_flows(df, keys, order_by)


def assert_rows(df: DataFrame, condition: Column | str, message: str) -> DataFrame:
    """Fail the job when a row breaks the condition. Keep the result: the check is part of it."""
    checked = F.when(holds(condition), F.lit(True)).otherwise(F.raise_error(F.lit(message)))
    return df.filter(checked)


def warn_rows(df: DataFrame, condition: Column | str, message: str) -> tuple[DataFrame, Callable[[], int]]:
    """Let rows that break the condition pass, and count them while an action runs.

    Afterwards the second item gives the number, with a warning where it is not 0.
    """
    seen = Observation()
    watched = df.observe(seen, F.count_if(~holds(condition)).alias("broken"))

    def broken() -> int:
        if seen.get["broken"]:
            warnings.warn(f"{message}: {seen.get['broken']} rows", stacklevel=2)
        return seen.get["broken"]

    return watched, broken


def assert_aggregate(df: DataFrame, condition: Column, message: str) -> None:
    """Fail now when a condition over aggregates of the input does not hold."""
    if not df.agg(holds(condition).alias("ok")).first()["ok"]:
        raise AssertionError(message)


def compare_counts(cases: DataFrame, strict_zero: bool = False) -> DataFrame:
    """Add difference, percentage and verdict to rows of ``COUNT_SCHEMA``.

    An empty source counts as 0 % off whatever the target has, unless ``strict_zero``.
    A missing count fails.
    """
    source, target = F.col("source_row_count"), F.col("target_row_count")
    exact = F.when(source > 0, (target - source) / source * 100).when(source.isNotNull() & target.isNotNull(), 0.0)
    passed = F.coalesce(F.abs(exact) <= F.coalesce("threshold_pct", F.lit(0.0)), F.lit(False))
    if strict_zero:
        passed = passed & ~((source == 0) & (target > 0))
    return cases.withColumns(
        {"difference": target - source, "difference_pct": F.round(exact, 2), "passed": passed}
    )


def count_tables(pairs: Mapping[str, tuple[DataFrame, DataFrame, float]]) -> DataFrame:
    """Rows of source and target per entity, for ``compare_counts``."""
    def count(entity: str, df: DataFrame, source: bool, threshold: float) -> DataFrame:
        n = F.count(F.lit(1))
        return df.agg((n if source else F.lit(0)).alias("s"), (F.lit(0) if source else n).alias("t")).select(
            F.lit(entity).alias("entity"), "s", "t", F.lit(float(threshold)).alias("threshold_pct")
        )

    parts = [count(e, df, side, pct) for e, (s, t, pct) in pairs.items() for df, side in ((s, True), (t, False))]
    counted = reduce(DataFrame.unionByName, parts).groupBy("entity")
    return counted.agg(
        F.sum("s").alias("source_row_count"),
        F.sum("t").alias("target_row_count"),
        F.max("threshold_pct").alias("threshold_pct"),
    )


def _digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row's values as text, wide enough to be added up."""
    values = [F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string") for c in columns]
    # xxhash64 passes over nulls, so each value brings a flag along
    parts = [p for v in values for p in (v.isNull(), v)]
    return [F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)") for seed in (1, 2)]


def diff_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """State of every key: matched, mismatched, missing or extra.

    Both sides go through one aggregation by key, combined before the exchange, in place of
    an outer join. Rows that share a key are compared as a bag: two 64-bit hashes per row are
    added up for the source and taken away for the target. ``source_rows`` and
    ``target_rows`` give how often the key occurs.
    """
    compare = list(compare) if compare is not None else [c for c in source.columns if c not in keys]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, F.lit(sign).alias("_sign"), *[(h * sign).alias(f"_h{i}") for i, h in enumerate(_digests(df, compare), 1)])

    grouped = side(source, 1).unionByName(side(target, -1)).groupBy(*keys).agg(
        F.count_if(F.col("_sign") == 1).alias("source_rows"),
        F.count_if(F.col("_sign") == -1).alias("target_rows"),
        F.sum("_h1").alias("_d1"),
        F.sum("_h2").alias("_d2"),
    )
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("_d1") == 0) & (F.col("_d2") == 0)
    state = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when(same, "matched")
        .otherwise("mismatched")
    )
    return grouped.select(*keys, "source_rows", "target_rows", state.alias("state"))


class TreeDiff(NamedTuple):
    """Keys that are not matched, and row counts: of both sides, and of the source in ranges that agree."""

    rows: DataFrame
    source_rows: int
    target_rows: int
    agreeing_rows: int


def diff_tree(
    source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None, bits: int = 10, leaf_rows: int = 64
) -> TreeDiff:
    """``diff_rows`` without its matched keys, for large tables that differ little.

    Keys are hashed to 64 bits and the hashes cut into 2**bits ranges. For each range the rows and the
    sums of two row hashes are compared, combined before the exchange; where they agree the range is done.
    Ranges that differ are cut again, down to about ``leaf_rows`` rows a range, and only rows in the last
    ranges that differ are compared key by key. What is exchanged grows with the differences; the tables
    are scanned once for each level, and the number of levels with the logarithm of their size. Where most
    ranges of a level differ, deeper ones would not help and are left out.
    """
    compare = list(compare) if compare is not None else [c for c in source.columns if c not in keys]
    columns = [*keys, *compare]
    place = F.xxhash64(*[p for k in keys for p in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`").cast("string"))])

    def ranged(df: DataFrame, used: int) -> DataFrame:
        return df.withColumn("_range", F.shiftrightunsigned(place, 64 - used))

    def sums(df: DataFrame, sign: int, used: int) -> DataFrame:
        first, second = _digests(df, columns)
        return df.select(F.shiftrightunsigned(place, 64 - used).alias("_range"), F.lit(sign).alias("_sign"), (first * sign).alias("_h1"), (second * sign).alias("_h2"))

    def level(pair: tuple[DataFrame, DataFrame], used: int) -> DataFrame:
        both = sums(pair[0], 1, used).unionByName(sums(pair[1], -1, used)).groupBy("_range")
        counted = both.agg(F.count_if(F.col("_sign") == 1).alias("_s"), F.count_if(F.col("_sign") == -1).alias("_t"), F.sum("_h1").alias("_d1"), F.sum("_h2").alias("_d2"))
        same = (F.col("_s") == F.col("_t")) & (F.col("_d1") == 0) & (F.col("_d2") == 0)
        return materialize(counted.select("_range", "_s", "_t", same.alias("_same")), "ranges")

    def inside(df: DataFrame, differing: DataFrame, used: int) -> DataFrame:
        return ranged(df, used).join(differing, "_range", "left_semi").drop("_range")

    used, pair = bits, (source, target)
    ranges = level(pair, used)
    source_rows, target_rows, n, wrong = ranges.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("_s", "_t")], F.count(F.lit(1)), F.count_if(~F.col("_same"))).first()
    while wrong and 2 * wrong <= n and (source_rows + target_rows) >> used > leaf_rows and used + bits <= 64:
        differing = ranges.filter("NOT _same").select("_range")
        used += bits
        ranges = level(tuple(inside(df, differing, used - bits) for df in (source, target)), used)
        n, wrong = ranges.agg(F.count(F.lit(1)), F.count_if(~F.col("_same"))).first()
    differing = ranges.filter("NOT _same")
    touched = differing.agg(F.coalesce(F.sum("_s"), F.lit(0))).first()[0]
    pair = tuple(inside(df, differing.select("_range"), used) for df in (source, target))
    rows = diff_rows(*pair, keys, compare).filter("state <> 'matched'")
    return TreeDiff(rows, source_rows, target_rows, source_rows - touched)


def tree_summary(found: TreeDiff, entity: str, keys: Sequence[str], samples: int = 10) -> DataFrame:
    """The columns of ``diff_summary``. Keys that match are counted by their source rows, so ``matched`` (and
    ``repeated_keys``, which sees only keys that differ) agrees with it where keys are single."""
    summary = diff_summary(found.rows, entity, keys, samples)
    matched = F.lit(found.source_rows).cast("bigint") - F.col("source_rows")
    base = F.greatest(F.lit(found.source_rows), F.lit(1))
    return summary.withColumns({
        "matched": matched, "match_rate_pct": F.round(matched / base * 100, 2),
        "source_rows": F.lit(found.source_rows).cast("bigint"), "target_rows": F.lit(found.target_rows).cast("bigint"),
    })


def diff_summary(rows: DataFrame, entity: str, keys: Sequence[str], samples: int = 10) -> DataFrame:
    """One row with the counts and the verdict; extra keys do not fail it. Sample keys are
    the first few in text order."""
    n = F.count(F.lit(1))
    key = F.to_json(F.struct(*keys))
    counts = rows.agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"),
        *[F.count_if(F.col("state") == s).alias(s) for s in ("matched", "mismatched", "missing", "extra")],
        F.count_if((F.col("source_rows") > 1) | (F.col("target_rows") > 1)).alias("repeated_keys"),
        n.alias("_keys"),
    )
    base = F.greatest(F.col("source_rows"), F.lit(1))
    summary = counts.select(
        F.lit(entity).alias("entity"), "source_rows", "target_rows", "matched", "mismatched", "missing", "extra",
        "repeated_keys",
        F.round(F.col("matched") / base * 100, 2).alias("match_rate_pct"),
        ((F.col("mismatched") == 0) & (F.col("missing") == 0)).alias("passed"),
    )
    if not samples:
        return summary
    for state in ("mismatched", "missing"):
        first = rows.filter(F.col("state") == state).select(key.alias("k")).orderBy("k").limit(samples)
        listed = first.agg(F.sort_array(F.collect_list("k")).alias("k")).scalar()
        summary = summary.withColumn(f"sample_{state}", listed)
    return summary


def sample_pair(
    source: DataFrame, target: DataFrame, keys: Sequence[str], n: int = C.DIFF_SAMPLE_SIZE, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``n`` source rows picked by key hash and the target rows with those keys."""
    chosen = materialize(sample_rows(source, n, keys, seed), "sample")
    return chosen, target.join(chosen.select(*keys), list(keys), "left_semi")


def data_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    entity: str = "",
    sample: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(summary, state per key) of two tables, or of a sample of their keys."""
    if sample:
        source, target = sample_pair(source, target, keys, sample)
    rows = diff_rows(source, target, keys, compare)
    return diff_summary(rows, entity, keys), rows


def schema_rows(spark: SparkSession, columns: T.StructType | Sequence[Mapping[str, object]]) -> DataFrame:
    """Column list as rows (name, type)."""
    if isinstance(columns, T.StructType):
        rows = [(f.name, f.dataType.simpleString()) for f in columns]
    else:
        rows = [(str(c["name"]), str(c.get("type", ""))) for c in columns]
    names, types = zip(*rows) if rows else ((), ())
    table = pa.table({"name": pa.array(names, pa.string()), "type": pa.array(types, pa.string())})
    return spark.createDataFrame(table)


def compare_schemas(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """State of every column: ok, missing, extra or type_mismatch; names and types in any case."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lower("name").alias("column_name"), F.upper("type").alias(f"{name}_type"))

    joined = side(expected, "expected").join(side(actual, "actual"), "column_name", "full")
    state = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "extra")
        .when(F.col("expected_type") != F.col("actual_type"), "type_mismatch")
        .otherwise("ok")
    )
    return joined.withColumn("state", state)


def schema_verdict(compared: DataFrame, entity: str) -> DataFrame:
    """One row per comparison; extra columns do not fail it."""
    def names(state: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("state") == state, F.col("column_name"))))

    return compared.agg(
        F.lit(entity).alias("entity"),
        F.count("expected_type").alias("expected_columns"),
        F.count("actual_type").alias("actual_columns"),
        names("missing").alias("missing_columns"),
        names("extra").alias("extra_columns"),
        names("type_mismatch").alias("type_mismatches"),
        (F.count_if(F.col("state").isin("missing", "type_mismatch")) == 0).alias("passed"),
    )


def compare_files(spark: SparkSession, left: str, right: str, name: Column | None = None) -> DataFrame:
    """Files of two folders by name: same, different or only on one side.

    The name is the path below the folder, or an expression over ``path``.
    """
    def side(root: str, label: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        below = F.substring_index("path", root.rstrip("/") + "/", -1) if name is None else name
        return files.select(below.alias("file"), F.sha2("content", 256).alias(f"{label}_hash"))

    joined = side(left, "left").join(side(right, "right"), "file", "full")
    state = (
        F.when(F.col("right_hash").isNull(), "left_only")
        .when(F.col("left_hash").isNull(), "right_only")
        .when(F.col("left_hash") == F.col("right_hash"), "same")
        .otherwise("different")
    )
    return joined.select("file", state.alias("state"))


def report(results: DataFrame, path: str, mode: str = "append") -> None:
    """Write check results as JSON lines."""
    results.write.mode(mode).json(path)
