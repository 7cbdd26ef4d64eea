"""Projection, filtering and row shaping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import constants as C
from rowloom.flows import Flows
from rowloom.operators.keys import apart


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def holds(condition: Column | str) -> Column:
    """The condition with unknown counted as false, so accepted and rejected rows add up."""
    return F.coalesce(_expr(condition), F.lit(False))


def map_columns(
    df: DataFrame,
    outputs: Mapping[str, Column | str],
    variables: Mapping[str, Column | str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Select named expressions; ``variables`` are named steps visible to them only."""
    for name, value in (variables or {}).items():
        df = df.withColumn(name, _expr(value))
    types = types or {}
    return df.select(
        *[(_expr(e).cast(types[n]) if n in types else _expr(e)).alias(n) for n, e in outputs.items()]
    )


def map_outputs(
    df: DataFrame,
    outputs: Mapping[str, tuple[Column | str | None, Mapping[str, Column | str]]],
    rejects: Mapping[str, Mapping[str, Column | str]] | None = None,
    variables: Mapping[str, Column | str] | None = None,
) -> dict[str, DataFrame]:
    """Several outputs of one input, each with its own filter and columns.

    ``rejects`` outputs take the rows that no filtered output accepted.
    """
    for name, value in (variables or {}).items():
        df = df.withColumn(name, _expr(value))
    result, taken = {}, F.lit(False)
    for name, (condition, columns) in outputs.items():
        keep = F.lit(True) if condition is None else holds(condition)
        taken = taken | keep
        result[name] = map_columns(df.filter(keep), columns)
    for name, columns in (rejects or {}).items():
        result[name] = map_columns(df.filter(~taken), columns)
    return result


def filter_flows(df: DataFrame, condition: Column | str) -> Flows:
    keep = holds(condition)
    return Flows(df.filter(keep), df.filter(~keep))


def split_flows(df: DataFrame, conditions: Mapping[str, Column | str], exclusive: bool = False) -> dict[str, DataFrame]:
    """One output per condition. A row may go to several unless ``exclusive``."""
    if not exclusive:
        return {name: df.filter(holds(c)) for name, c in conditions.items()}
    result, seen = {}, F.lit(False)
    for name, condition in conditions.items():
        result[name] = df.filter(holds(condition) & ~seen)
        seen = seen | holds(condition)
    return result


def choose(cases: Sequence[tuple[Column | str, object]], otherwise: object = None) -> Column:
    """First case that holds gives the value."""
    result = F
    for condition, value in cases:
        result = result.when(_expr(condition), value)
    return result.otherwise(otherwise)


def keep_columns(df: DataFrame, keep: Sequence[str] | Callable[[T.StructField], bool]) -> DataFrame:
    """Keep columns by name, or by a test on name and type for inputs of unknown shape."""
    names = [f.name for f in df.schema if keep(f)] if callable(keep) else [c for c in keep if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in one projection; names the input lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast the columns that exist. Bad values raise when ``strict``, else become null."""
    def convert(name: str, to: str) -> Column:
        return F.col(name).cast(to) if strict else F.col(name).try_cast(to)

    return df.withColumns({c: convert(c, t) for c, t in types.items() if c in df.columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object], blank: bool = False) -> DataFrame:
    """Replace nulls (and empty strings when ``blank``) in the columns that exist."""
    def filled(name: str, default: object) -> Column:
        value = F.col(name)
        if blank:
            value = F.when(F.trim(value.cast("string")) != "", value)
        return F.coalesce(value, F.lit(default))

    return df.withColumns({c: filled(c, d) for c, d in defaults.items() if c in df.columns})


def replace_text(df: DataFrame, column: str, rules: Sequence[tuple[str, str]], regex: bool = True) -> DataFrame:
    value = F.col(column)
    for search, replacement in rules:
        value = (
            F.regexp_replace(value, search, replacement)
            if regex
            else F.replace(value, F.lit(search), F.lit(replacement))
        )
    return df.withColumn(column, value)


def split_to_rows(
    df: DataFrame, column: str, separator: str, out: str | None = None, trim: bool = True, keep_null: bool = False
) -> DataFrame:
    """One row per item of a delimited cell; the separator is literal text."""
    items = F.split(F.col(column), _literal(separator))
    if trim:
        items = F.transform(items, lambda x: F.trim(x))
    out = out or column
    exploded = F.explode_outer(items) if keep_null else F.explode(items)
    others = [F.col(c) for c in df.columns if c != out]
    return df.select(*others, exploded.alias(out))


def columns_to_rows(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def _literal(text: str) -> str:
    """The text as a Java regular expression that matches only itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def delimited_fields(df: DataFrame, column: str, separator: str, fields: Mapping[str, str]) -> DataFrame:
    """Parts of a delimited cell as typed columns; absent or bad parts are null."""
    parts = F.split(F.col(column), _literal(separator))
    return df.withColumns({n: F.get(parts, F.lit(i)).try_cast(t) for i, (n, t) in enumerate(fields.items())})


def regex_fields(df: DataFrame, column: str, pattern: str, fields: Mapping[str, str]) -> Flows:
    """Groups of a pattern as typed columns; rows that do not match are rejects."""
    hit = holds(F.col(column).rlike(pattern))
    groups = {n: F.regexp_extract(column, pattern, i).try_cast(t) for i, (n, t) in enumerate(fields.items(), start=1)}
    return Flows(df.filter(hit).withColumns(groups), df.filter(~hit))


def json_fields(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Fields of a JSON cell as columns, parsed once per row."""
    parsed = df.withColumn("_json", F.from_json(F.col(column), schema))
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    return parsed.withColumns({n: F.col(f"_json.`{n}`") for n in names}).drop("_json")


def json_paths(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: F.get_json_object(column, p) for n, p in paths.items()})


def xml_fields(df: DataFrame, column: str, schema: str | T.StructType, options: Mapping[str, str] | None = None) -> DataFrame:
    """Fields of an XML cell as columns."""
    parsed = df.withColumn("_xml", F.from_xml(F.col(column), schema, dict(options or {})))
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    return parsed.withColumns({n: F.col(f"_xml.`{n}`") for n in names}).drop("_xml")


def xml_paths(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: F.xpath_string(F.col(column), F.lit(p)) for n, p in paths.items()})


def audit_columns(df: DataFrame, source: str, loaded_at: dt.datetime | Column, run_date: bool = True) -> DataFrame:
    """Load time, source name and run date; the time is given so that runs can be repeated."""
    at = loaded_at if isinstance(loaded_at, Column) else C.clock(loaded_at)
    added = {C.LOADED_AT: at, C.SOURCE_NAME: F.lit(source)}
    if run_date:
        added[C.RUN_DATE] = at.cast("date")
    return df.withColumns(added)


def row_hash(columns: Sequence[str | Column], algorithm: str = "md5", safe: bool = False) -> Column:
    """Hash of a row for change detection.

    The plain form joins the values with two pipes and writes nulls as ``NULL``, so a value
    that holds either can collide. ``safe`` hashes a JSON form that cannot.
    """
    values = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
    if safe:
        text = F.to_json(F.struct(*[v.alias(f"c{i}") for i, v in enumerate(values)]), {"ignoreNullFields": "false"})
    else:
        text = F.concat_ws(
            C.HASH_SEPARATOR, *[F.coalesce(v.cast("string"), F.lit(C.HASH_NULL)) for v in values]
        )
    if algorithm == "md5":
        return F.md5(text)
    if algorithm.startswith("sha"):
        return F.sha2(text, int(algorithm[3:]))
    raise ValueError(f"unknown hash {algorithm!r}")


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    return df.withColumn(C.ROW_HASH, row_hash(columns or df.columns, **options))


def mask(column: str | Column, method: str = "hash", *, keep_last: int = 4, pattern: str = ".", put: str = "*") -> Column:
    """Hide a value: ``hash`` (SHA-256), ``chars`` (letters and digits by class),
    ``tail`` (all but the last characters) or ``pattern`` (a regular expression)."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    if method == "hash":
        return F.sha2(value, 256)
    if method == "chars":
        return F.mask(value)
    if method == "tail":
        hidden = F.greatest(F.length(value) - keep_last, F.lit(0))
        return F.concat(F.repeat(F.lit(put), hidden), F.substring(value, hidden + 1, F.length(value)))
    if method == "pattern":
        return F.regexp_replace(value, pattern, put)
    raise ValueError(f"unknown mask {method!r}")


def standardize(df: DataFrame, column: str, reference: DataFrame, variant: str, standard: str) -> DataFrame:
    """Replace known variants by their standard form; other values stay.

    ``reference`` has one row per variant. Compared in upper case without outer blanks.
    """
    def norm(c: str) -> Column:
        return F.upper(F.trim(F.col(c)))

    pairs = reference.groupBy(norm(variant).alias("_variant")).agg(F.min(standard).alias("_standard"))
    pairs = pairs.select(apart("_variant").alias("_variant"), "_standard")
    joined = df.withColumn("_lookup", norm(column)).join(pairs, F.col("_lookup") == F.col("_variant"), "left")
    return joined.withColumn(column, F.coalesce("_standard", F.col(column))).drop("_lookup", "_variant", "_standard")


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, keys: Sequence[str], buckets: int, bucket: int = 0) -> DataFrame:
    """The same rows on every run: keys whose hash falls in one of ``buckets``."""
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(buckets)) == bucket)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows spread over the input by key hash, the same on every run.

    Hashes above a bound that about twice as many rows pass are left out before the rows are
    put in order, so that few rows meet in the last task. Should fewer than ``n`` pass, as
    repeated keys can bring about, all rows are put in order.
    """
    total = df.count()
    if total <= n:
        return df
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *keys))
    share = (2 * n + 100) / total
    if share < 1:
        bound = int(-(2**63) + share * 2**64)
        few = hashed.filter(F.col("_hash") <= bound)
        if few.count() >= n:
            hashed = few
    return hashed.orderBy("_hash", *keys).limit(n).drop("_hash")


def with_parameters(df: DataFrame, parameters: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Job parameters as typed columns: name -> (value, type)."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in parameters.items()})


def replicate(df: DataFrame, branches: Mapping[str, Callable[[DataFrame], DataFrame]], persist: bool = True) -> dict[str, DataFrame]:
    """One input for several outputs, read once. Spills to disk; call ``unpersist`` on the
    input when the outputs are written."""
    base = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    return {name: branch(base) for name, branch in branches.items()}


FLOW = "_flow"


class FanOut:
    """Several flows of one input, tagged in a single pass.

    ``flows`` gives for each name which rows belong to it (None: all) and what its columns are (None: all
    of the input). A row is read once and exploded into the flows it belongs to; nothing is kept in memory.
    """

    def __init__(self, df: DataFrame, flows: Mapping[str, tuple[Column | str | None, Mapping[str, Column] | None]]) -> None:
        self.columns = {name: dict(columns) if columns is not None else {c: F.col(f"`{c}`") for c in df.columns} for name, (_, columns) in flows.items()}
        kinds = {}
        for columns in self.columns.values():
            for field in df.select(*[c.alias(n) for n, c in columns.items()]).schema:
                if kinds.setdefault(field.name, field.dataType) != field.dataType:
                    raise ValueError(f"column {field.name} has several types")
        tagged = []
        for name, (where, _) in flows.items():
            own = self.columns[name]
            row = F.struct(F.lit(name).alias(FLOW), *[(own[c] if c in own else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])
            tagged.append(row if where is None else F.when(holds(where), row))  # a missing else is null
        self.rows = df.select(F.explode(F.array_compact(F.array(*tagged))).alias("r")).select("r.*")

    def write(self, path: str, mode: str = "errorifexists", format: str = "parquet") -> dict[str, DataFrame]:
        """Write all flows in one job, each to a folder of its own, and give them as they are read from there."""
        self.rows.write.format(format).mode(mode).partitionBy(FLOW).save(path)
        written = self.rows.sparkSession.read.format(format).schema(self.rows.schema).load(path)
        return {name: written.filter(F.col(FLOW) == name).select(*[F.col(f"`{c}`") for c in columns]) for name, columns in self.columns.items()}
