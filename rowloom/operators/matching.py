"""Record matching: similar values, groups of matching records, and the record that survives."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.keys import apart, first_per_key
from rowloom.session import materialize


# deletion variants of a text at most; longer texts are found by their segments
VARIANTS = 4096
# pairs that one key may bring forth before its texts are told apart further
HOT_PAIRS = 10_000


def deletion_variants(value: Column, distance: int) -> Column:
    """The value and everything left after deleting up to ``distance`` characters.

    Two texts within that edit distance share a variant, so joining on variants finds every
    pair. A variant has a number of distinct neighbours that depends on its length and the
    alphabet only, not on the number of rows.
    """
    def shorter(text: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.length(text))
        return F.when(
            F.length(text) > 0,
            F.transform(cuts, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text)))),
        ).otherwise(F.array().cast("array<string>"))

    reached = layer = F.array(value)
    for _ in range(distance):
        layer = F.array_distinct(F.flatten(F.transform(layer, shorter)))
        reached = F.array_union(reached, layer)
    return reached


def short_length(distance: int) -> int:
    """The longest text with at most ``VARIANTS`` deletion variants."""
    n = 0
    while sum(math.comb(n + 1, k) for k in range(distance + 1)) <= VARIANTS and n < VARIANTS:
        n += 1
    return n


def _cut(rest: Column, size: Column, i: Column, start: Column, length: Column) -> Column:
    """The part of a text as a key, with the text without it."""
    part = F.xxhash64(size, i, F.substring(rest, start + 1, length))
    return F.struct(part.alias("key"), F.concat(F.substring(rest, F.lit(1), start), F.substring(rest, start + length + 1, F.length(rest))).alias("rest"))


def _bounds(size: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start and length of segment ``i`` of a text of so many characters."""
    start = (size * i / parts).cast("int")
    return start, (size * (i + 1) / parts).cast("int") - start


def _segments(rest: Column, distance: int) -> Column:
    """The text cut into ``distance`` + 1 segments: a key of each, and the text without it."""
    size = F.length(rest)
    return F.transform(F.sequence(F.lit(0), F.lit(distance)), lambda i: _cut(rest, size, i, *_bounds(size, i, distance + 1)))


def _substrings(rest: Column, distance: int, longest: int) -> Column:
    """Where segments of texts of like length may stand in this one, as keys and the text without them.

    For a pair within the distance some segment i is whole, with at most i edits before it and
    ``distance`` - i after it, which bounds its place from both ends (Li et al., "Pass-Join", 2011).
    The other text is up to ``longest`` characters longer and up to ``distance`` shorter.
    """
    own, parts = F.length(rest), distance + 1

    def at_length(more: Column, i: Column) -> Column:
        size = own + more
        start, length = _bounds(size, i, parts)
        low = F.greatest(start - i, start - more - (distance - i), F.lit(0))
        high = F.least(start + i, start - more + (distance - i), own - length)
        places = F.when((low <= high) & (size >= parts), F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: _cut(rest, size, i, at, length))

    def at_segment(i: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(-distance), F.lit(longest)), lambda more: at_length(more, i)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(distance)), at_segment))


def _near(a: DataFrame, b: DataFrame, distance: int, single: bool) -> DataFrame:
    """Pairs (``left_value``, ``right_value``, ``distance``) of written distinct texts, column ``value``.

    With ``single`` both are the same table, and a pair comes once, the lesser text at the left.
    Every candidate is verified, so keys may clash. Texts that share a common key, a passage that many
    have, say, are cut again without it, until keys are rare or what is left is short.
    """
    short = short_length(distance)
    verified: list[DataFrame] = []

    def verify(left: DataFrame, right: DataFrame) -> None:
        both = left.select("key", F.col("value").alias("left_value")).join(right.select("key", F.col("value").alias("right_value")), "key")
        if single:
            both = both.filter("left_value <> right_value").select("key", F.least("left_value", "right_value").alias("left_value"), F.greatest("left_value", "right_value").alias("right_value"))
        both = both.select("left_value", "right_value")
        near = both.withColumn("distance", F.levenshtein("left_value", "right_value", distance)).filter("distance >= 0")
        verified.append(near)

    def by_variants(df: DataFrame) -> DataFrame:
        hashed = F.transform(deletion_variants(F.col("rest"), distance), lambda v: F.xxhash64(v))
        return df.filter(F.length("rest") <= short + distance).select("value", F.explode(F.array_distinct(hashed)).alias("key"))

    left, right = (df.select("value", F.col("value").alias("rest")) for df in (a, b))
    while True:
        variants = by_variants(left)
        verify(variants, variants if single else by_variants(right))
        left, right = (df.filter(F.length("rest") > short - distance) for df in (left, right))
        if left.isEmpty() or right.isEmpty():
            break
        left = left.select("value", F.explode(_substrings(F.col("rest"), distance, 0 if single else distance)).alias("s"))
        right = right.select("value", F.explode(_segments(F.col("rest"), distance)).alias("s"))
        left, right = (materialize(df.select("value", "s.key", "s.rest"), "segments") for df in (left, right))
        counts = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(right.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "key")
        hot = materialize(counts.filter(F.col("n") * F.col("m") > HOT_PAIRS).select("key"), "hot-keys")
        if hot.isEmpty():
            verify(left, right)
            break
        verify(left.join(hot, "key", "left_anti"), right.join(hot, "key", "left_anti"))
        # of such a pair the texts without the common segment are within the distance as well
        left, right = (_spread(materialize(df.join(hot, "key", "left_semi").select("value", "rest").distinct(), "rests")) for df in (left, right))
    return reduce(DataFrame.unionByName, verified).distinct()


def _texts(df: DataFrame, column: str) -> DataFrame:
    return _spread(materialize(df.select(F.col(f"`{column}`").alias("value")).filter("value is not null").distinct(), "texts"))


def _spread(df: DataFrame) -> DataFrame:
    """Few bytes that much is made of: over all cores, where the files alone would not reach them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


def similar_values(left: DataFrame, right: DataFrame, left_col: str, right_col: str, max_distance: int) -> DataFrame:
    """Pairs of distinct values within an edit distance, with that distance.

    Works on distinct values, so copies cost nothing; the pairs found are exact. Short texts meet by
    hashes of what deletions leave of them, long ones by whole segments.
    """
    return _near(_texts(left, left_col), _texts(right, right_col), max_distance, single=False)


def similar_pairs(df: DataFrame, column: str, max_distance: int) -> DataFrame:
    """As ``similar_values`` of a table with itself, but every unordered pair of unlike values once."""
    texts = _texts(df, column)
    return _near(texts, texts, max_distance, single=True)


def fuzzy_lookup(
    main: DataFrame, table: DataFrame, main_col: str, table_col: str, max_distance: int, order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Every main row with its closest lookup value (``match_value``, ``match_distance``);
    null when none is near enough. Ties go to the first value in text order."""
    pairs = similar_values(main, table, main_col, table_col, max_distance)
    best = first_per_key(pairs, ["left_value"], ["distance", *order_by, "right_value"]).select(
        apart("left_value").alias("_value"),
        F.col("right_value").alias("match_value"),
        F.col("distance").alias("match_distance"),
    )
    return main.join(best, main[main_col] == best["_value"], "left").drop("_value")


def connected_groups(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, group) for the connected parts of a graph; a group is named by its least node.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected Components
    in MapReduce and Beyond" (2014), until nothing changes. Each step is a minimum per node
    and a join back, so no node's neighbours are ever collected.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    pairs = materialize(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, state = None, _fingerprint(pairs)
    while state != before:
        pairs = materialize(_small_star(_large_star(pairs)), "edges")
        before, state = state, _fingerprint(pairs)
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("group"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("group", "node").alias("group"))


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("u"), F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.filter("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    linked = pairs.join(least.select(apart("u").alias("u"), "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.unionByName(own).filter("u <> v").distinct()


def match_groups(df: DataFrame, column: str, max_distance: int, group: str = "match_group") -> DataFrame:
    """Add to each row the group of its value: values linked by edit distance, directly or
    through others. Rows without a value have no group."""
    texts = _texts(df, column)
    pairs = _near(texts, texts, max_distance, single=True).select("left_value", "right_value")
    # a value without a like is a group of its own
    pairs = pairs.unionByName(texts.select(F.col("value").alias("left_value"), F.col("value").alias("right_value")))
    groups = connected_groups(pairs, "left_value", "right_value")
    groups = groups.select(apart("node").alias("_node"), F.col("group").alias(group))
    return df.join(groups, df[column] == groups["_node"], "left").drop("_node")


def survivors(df: DataFrame, group: Sequence[str], rules: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """One row per group with the best value of each attribute.

    A rule is (kind, column): ``latest``/``earliest`` by a column, ``longest``, ``most_common``,
    ``highest`` or ``lowest``. Nulls never survive a value. All rules combine before the
    exchange; equal ranks go to the least value, or the highest for ``latest``.
    """
    def best(name: str, kind: str, by: str | None) -> Column:
        value = F.col(name)
        if kind in ("latest", "earliest"):
            pick = F.max if kind == "latest" else F.min
            ranked = F.struct(F.col(by).alias("r"), value.alias("v"))
            return pick(F.when(value.isNotNull() & F.col(by).isNotNull(), ranked))["v"]
        if kind == "longest":
            return F.min(F.when(value.isNotNull(), F.struct((-F.length(value)).alias("r"), value.alias("v"))))["v"]
        if kind == "highest":
            return F.max(value)
        if kind == "lowest":
            return F.min(value)
        raise ValueError(f"unknown rule {kind!r}")

    single = {n: rule for n, rule in rules.items() if rule[0] != "most_common"}
    result = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), *[best(n, *rule).alias(n) for n, rule in single.items()]
    )
    for name in (n for n, rule in rules.items() if rule[0] == "most_common"):
        # count per value first: a group may hold any number of values
        counted = df.filter(F.col(name).isNotNull()).groupBy(*group, name).agg(F.count(F.lit(1)).alias("_n"))
        top = counted.groupBy(*group).agg(F.min(F.struct((-F.col("_n")).alias("r"), F.col(name).alias("v")))["v"].alias(name))
        top = top.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], name)
        match = reduce(lambda a, b: a & b, [result[g].eqNullSafe(top[f"_g{i}"]) for i, g in enumerate(group)])
        result = result.join(top, match, "left").drop(*[f"_g{i}" for i in range(len(group))])
    return result.select(*group, *rules)
