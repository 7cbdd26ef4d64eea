"""Connected components by union-find within tasks and minimum labels between them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.keys import apart
from rowloom.session import materialize


def _union_find(batches):
    """A forest of the edges of one partition: every node with the least node it is joined to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.record_batch({"a": pa.array(nodes, pa.int64()), "b": pa.array([root(x) for x in nodes], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected to, of every node with an edge (columns a, b).

    Union-find turns each partition's edges into a forest. Then each node takes the least label around
    it and passes it to larger neighbours, until the edges are stars around roots: a hot root costs one
    row per neighbour, and its minimum is combined before the exchange. Every round is written.
    """
    edges = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a != b")
    edges = materialize(edges.mapInArrow(_union_find, "a bigint, b bigint"), "forest")
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large step: neighbours above a node move to its least label
        large = edges.join(least.select(apart("a").alias("u"), "m"), edges["b"] == F.col("u"), "inner").select(F.col("a"), F.col("m").alias("b"))
        large = large.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        # small step: a node and its labels below meet at the least of them
        below = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(below.select(apart("u").alias("u"), "m"), large["a"] == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = small.unionByName(below.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a != b").distinct()
        edges = materialize(stars, "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
