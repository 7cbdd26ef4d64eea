"""Hard-negative mining over a multiway hyperplane tree whose nodes know distance ranges (GNAT).

Vectors become integers, so scores (inner products) are exact. A node of the tree has up to ``FANOUT`` split
points; a vector belongs to the child of the nearest one, which cuts space by the hyperplanes between them.
The split points come from a sample of at most ``SAMPLE_ROWS`` vectors; they decide how fast a search is,
never what it finds. Every row is then routed to a leaf, and each node keeps, for every child and every
split point, the least and largest distance between that split point and the vectors of that child, and
the range of their lengths. The index is written by leaf and by distance to the leaf's split point; equal
vectors are spread over tasks by a hash of their ids.

A search asks for scores in a window [low, high]. With d^2 = |a|^2 + |x|^2 - 2 a.x the window is an annulus
around the anchor. A child is passed over when, by the triangle inequality on the distance range of any of
the split points, its vectors lie inside or outside of the annulus; runs of rows within a leaf are tested
alike by their distances to the leaf's split point. What is left is scored row by row.

Anchors come in blocks of at most ``BLOCK``, one at a time in the driver and in a broadcast. A probe of one
leaf for each anchor gives a first k-th best, so that tasks keep few rows beyond those that stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.words import give_back
from rowloom.session import materialize, scratch_path

SCALE = 256
SAMPLE_ROWS = 4096
FANOUT, LEAF_SAMPLE = 16, 64
BLOCK = 16_384
RUN_ROWS, CELLS = 2048, 1 << 20
# squared length up to which scores, and hundred times a score, fit 64 bits
MOST_LENGTH = float(1 << 55)
SLACK = 1e-6
NO_ID, NONE = np.iinfo(np.int64).max, np.iinfo(np.int64).min
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
HITS = "anchor int, slot int, anchor_id bigint, slot_id bigint, slot_score bigint, other bigint, score bigint"


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(float) ** 2).sum(axis=1))


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distance of every row to every point, in floating point."""
    x, points = x.astype(float), points.astype(float)
    square = (x**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    """Split points of every node; a child is a node's number, or -1 - the number of a leaf."""

    def __init__(self, sample: np.ndarray, fanout: int, leaf_sample: int) -> None:
        self.splits: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        self.paths: list[list[tuple[int, int]]] = []  # of every leaf: (node, child) from the root
        self._random = np.random.default_rng(0)
        self._grow(np.unique(sample, axis=0), [], fanout, leaf_sample)

    def _grow(self, points: np.ndarray, path: list[tuple[int, int]], fanout: int, leaf_sample: int) -> int:
        if path and len(points) <= leaf_sample:
            self.paths.append(path)
            return -len(self.paths)
        drawn = points[self._random.permutation(len(points))[: 3 * fanout]]
        chosen, near = [0], distances(drawn, drawn[:1])[:, 0]
        while len(chosen) < min(fanout, len(drawn)):
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(drawn, drawn[chosen[-1:]])[:, 0])
        node = len(self.splits)
        self.splits.append(drawn[chosen])
        self.children.append(np.zeros(len(chosen), np.int64))
        nearest = distances(points, drawn[chosen]).argmin(axis=1)
        for j in range(len(chosen)):
            self.children[node][j] = self._grow(points[nearest == j], [*path, (node, j)], fanout, leaf_sample)
        return node

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of every row and its distance to the leaf's split point."""
        leaf, distance = np.zeros(len(x), np.int64), np.zeros(len(x))
        open_nodes = [(0, np.arange(len(x)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            d = distances(x[rows], self.splits[node])
            nearest = d.argmin(axis=1)
            for j in np.unique(nearest):
                some = nearest == j
                child = int(self.children[node][j])
                if child >= 0:
                    open_nodes.append((child, rows[some]))
                else:
                    leaf[rows[some]], distance[rows[some]] = -1 - child, d[some, j]
        return leaf, distance

    def split_of(self, leaf: int) -> np.ndarray:
        node, j = self.paths[leaf][-1]
        return self.splits[node][j]


class Ranges:
    """Least and largest distance to every split point, and lengths, of the vectors of every child."""

    def __init__(self, tree: Tree) -> None:
        self.low = [np.full((len(s), len(s)), np.inf) for s in tree.splits]
        self.high = [np.full((len(s), len(s)), -np.inf) for s in tree.splits]
        self.short = [np.full(len(s), np.inf) for s in tree.splits]
        self.long = [np.full(len(s), -np.inf) for s in tree.splits]

    def rows(self) -> pa.RecordBatch:
        """As rows (node, child, split, low, high); split -1 stands for lengths."""
        out: list[tuple] = []
        for node in range(len(self.low)):
            for j in np.flatnonzero(self.long[node] >= 0).tolist():
                out.append((node, j, -1, self.short[node][j], self.long[node][j]))
                out += [(node, j, i, self.low[node][j, i], self.high[node][j, i]) for i in range(len(self.long[node]))]
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["node", "child", "split", "low", "high"])

    def take(self, found: pa.Table) -> None:
        for node, j, i, low, high in zip(*(found[c].to_pylist() for c in ("node", "child", "split", "low", "high")), strict=True):
            if i < 0:
                self.short[node][j], self.long[node][j] = low, high
            else:
                self.low[node][j, i], self.high[node][j, i] = low, high


def dense(lists: pa.ListArray, width: int) -> np.ndarray:
    """Integer vectors as a matrix; missing components at the end are 0."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def _indexed(shared, width: int):
    def run(batches):
        tree = shared.value
        for batch in batches:
            x = dense(batch.column(2), width)
            leaf, distance = tree.route(x)
            yield pa.record_batch({"leaf": leaf.astype(np.int32), "distance": distance, "id": batch.column(0), "label": batch.column(1), "vector": pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary())})

    return run


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), np.int32).reshape(len(vectors), width).astype(np.int64)


def _measured(shared, width: int):
    """Ranges of the rows along the paths to the leaves that they were routed to."""

    def run(batches):
        tree = shared.value
        ranges = Ranges(tree)
        for batch in batches:
            leaves, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            length = lengths(x)
            for leaf in np.unique(leaves):
                rows = leaves == leaf
                for node, j in tree.paths[leaf]:
                    d = distances(x[rows], tree.splits[node])
                    ranges.low[node][j] = np.minimum(ranges.low[node][j], d.min(axis=0))
                    ranges.high[node][j] = np.maximum(ranges.high[node][j], d.max(axis=0))
                    ranges.short[node][j] = min(ranges.short[node][j], length[rows].min())
                    ranges.long[node][j] = max(ranges.long[node][j], length[rows].max())
        yield ranges.rows()

    return run


class Index:
    """The written rows, the tree over them and its ranges."""

    def __init__(self, rows: DataFrame, fanout: int = FANOUT, leaf_sample: int = LEAF_SAMPLE, sample_rows: int = SAMPLE_ROWS) -> None:
        """``rows``: id, label, vector (integers); written, as they are read several times."""
        spark = rows.sparkSession
        self.width = max(rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0], 1)
        drawn = rows.select("vector").orderBy(F.xxhash64("id", "vector")).limit(sample_rows).toArrow()
        self.tree = None
        if not drawn.num_rows:
            return
        self.tree = Tree(dense(drawn["vector"].combine_chunks(), self.width), fanout, leaf_sample)
        shared = spark.sparkContext.broadcast(self.tree)
        label = rows.schema["label"].dataType.simpleString()
        routed = rows.select("id", "label", "vector").mapInArrow(_indexed(shared, self.width), f"leaf int, distance double, id bigint, label {label}, vector binary")
        order = ["leaf", "distance", F.xxhash64("id")]
        self.rows = materialize(routed.repartitionByRange(*order).sortWithinPartitions(*order), "tree")
        found = self.rows.select("leaf", "vector").mapInArrow(_measured(shared, self.width), "node int, child int, split int, low double, high double")
        self.ranges = Ranges(self.tree)
        self.ranges.take(found.groupBy("node", "child", "split").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow())
        self.shared = spark.sparkContext.broadcast((self.tree, self.ranges))


class Wanted:
    """Anchors of a block with their windows: for every anchor and slot the scores wanted, and the k best so far."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, slots: int, k: int, same: bool) -> None:
        self.ids, self.labels, self.vectors, self.k, self.same = ids, labels, vectors, k, same
        shape = (len(ids), slots)
        self.low, self.high = np.full(shape, NONE), np.full(shape, NO_ID)
        self.slot_id, self.slot_score = np.full(shape, NO_ID), np.zeros(shape, np.int64)
        self.least, self.least_id = np.full(shape, NONE), np.full(shape, NO_ID)  # k-th best known
        self.probe: np.ndarray | None = None  # the one leaf to look at


class Search:
    """One task's search through its rows of the index."""

    def __init__(self, wanted: Wanted, tree: Tree, ranges: Ranges) -> None:
        self.w, self.tree, self.ranges = wanted, tree, ranges
        self.length = lengths(wanted.vectors)
        self.vectors = wanted.vectors.astype(float)
        self.least, self.least_id = wanted.least.copy(), wanted.least_id.copy()
        self.best = [np.zeros(0, np.int64)] * 3  # window, score, id
        self.new: list[tuple[np.ndarray, ...]] = []
        self.n_new = 0
        self.near: dict[int, np.ndarray] = {}
        self.scored = 0

    def _window(self) -> tuple[np.ndarray, np.ndarray]:
        return np.maximum(self.w.low, self.least).min(axis=1), self.w.high.max(axis=1)

    def _possible(self, rows, near, low, high, short, long) -> np.ndarray:
        """Whether vectors with such distances to the split points, and such lengths, may score inside the window."""
        least, most = self._window()
        a = self.length[rows]
        slack = SLACK * (1 + a + long)
        inner = a**2 + short**2 - 2 * np.where(most[rows] == NO_ID, np.inf, most[rows])
        outer = a**2 + long**2 - 2 * np.where(least[rows] == NONE, -np.inf, least[rows])
        inner, outer_at = np.sqrt(np.maximum(inner, 0)) - slack, np.sqrt(np.maximum(outer, 0)) + slack
        farthest = (near + high).min(axis=1)
        nearest = np.maximum(near - high, low - near).max(axis=1)
        return (outer >= -slack * (1 + a + long)) & (farthest >= inner) & (nearest <= outer_at)

    def leaf(self, leaf: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, distance: np.ndarray) -> None:
        w = self.w
        rows = np.arange(len(w.ids)) if w.probe is None else np.flatnonzero(w.probe == leaf)
        path = self.tree.paths[leaf]
        self.near = {node: self.near[node] for node, _ in path if node in self.near}
        for node, j in path:
            if not len(rows):
                return
            if node not in self.near:
                self.near[node] = distances(w.vectors, self.tree.splits[node])
            r = self.ranges
            rows = rows[self._possible(rows, self.near[node][rows], r.low[node][j], r.high[node][j], r.short[node][j], r.long[node][j])]
        node, j = path[-1]
        length = lengths(x)
        rows = rows[self._possible(rows, self.near[node][rows, j : j + 1], distance.min(), distance.max(), length.min(), length.max())]
        exact = self.length.max(initial=0) * length.max() < 2.0**53
        step = max(CELLS // len(ids), 1)
        for a in range(0, len(rows), step):
            self._score(rows[a : a + step], ids, labels, x, exact)

    def _score(self, rows, ids, labels, x, exact: bool) -> None:
        w = self.w
        score = (self.vectors[rows] @ x.T.astype(float)).astype(np.int64) if exact else w.vectors[rows] @ x.T
        self.scored += score.size
        fit = (w.labels[rows][:, None] == labels[None, :]) == w.same
        if w.same:
            fit &= (w.ids[rows][:, None] != ids[None, :]) | (ids == NO_ID)[None, :]
        for slot in range(w.low.shape[1]):
            low = np.maximum(w.low[rows, slot], self.least[rows, slot])
            a, b = np.nonzero(fit & (score >= low[:, None]) & (score <= w.high[rows, slot][:, None]))
            found, other = score[a, b], ids[b]
            window = rows[a] * w.low.shape[1] + slot
            good = (found > self.least.ravel()[window]) | (other <= self.least_id.ravel()[window])
            self.new.append((window[good], found[good], other[good]))
            self.n_new += int(good.sum())
        if self.n_new > CELLS // 16:
            self.settle()

    def settle(self) -> None:
        """Keep the k best of every window and note its k-th."""
        window, score, other = (np.concatenate(c) for c in zip(self.best, *self.new, strict=True))
        order = np.lexsort((other, -score, window))
        window, score, other = window[order], score[order], other[order]
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])) if len(window) else np.zeros(0, np.int64)
        rank = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        last = rank == self.w.k - 1
        self.least.ravel()[window[last]], self.least_id.ravel()[window[last]] = score[last], other[last]
        keep = rank < self.w.k
        self.best = [window[keep], score[keep], other[keep]]
        self.new, self.n_new = [], 0

    def hits(self) -> pa.RecordBatch:
        self.settle()
        window, score, other = self.best
        w = self.w
        slots = w.low.shape[1]
        anchor, slot = window // slots, window % slots

        def ids(x: np.ndarray) -> pa.Array:
            return pa.array(x, pa.int64(), mask=x == NO_ID)

        return pa.record_batch({
            "anchor": anchor.astype(np.int32), "slot": slot.astype(np.int32), "anchor_id": ids(w.ids[anchor]), "slot_id": ids(w.slot_id[anchor, slot]),
            "slot_score": w.slot_score[anchor, slot], "other": ids(other), "score": score,
        })


def _search(shared, index, width: int):
    def run(batches):
        search = Search(shared.value, *index.value)
        for batch in batches:
            leaf, distance = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids, labels = batch.column(2).fill_null(NO_ID).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(leaf)) + 1
            edges = np.unique(np.concatenate([[0], edges, np.arange(0, len(leaf), RUN_ROWS), [len(leaf)]]))
            for a, b in zip(edges, edges[1:], strict=False):
                search.leaf(int(leaf[a]), ids[a:b], labels[a:b], matrix(batch.column(4).slice(a, b - a), width), distance[a:b])
            give_back()
        yield search.hits()

    return run


def _best(hits: DataFrame, k: int, only_last: bool = False) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("other").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.filter(F.col("rank") == k) if only_last else ranked


def _run(index: Index, wanted: Wanted) -> DataFrame:
    shared = index.rows.sparkSession.sparkContext.broadcast(wanted)
    return index.rows.mapInArrow(_search(shared, index.shared, index.width), HITS)


def _probed(index: Index, wanted: Wanted, leaves: np.ndarray) -> Wanted:
    """Look at one leaf for each anchor, and note the k-th best where that is enough to know one."""
    wanted.probe = leaves
    found = _best(_run(index, wanted), wanted.k, only_last=True).select("anchor", "slot", "other", "score").toArrow()
    at = (found["anchor"].to_numpy(), found["slot"].to_numpy())
    wanted.least[at], wanted.least_id[at] = found["score"].to_numpy(), found["other"].fill_null(NO_ID).to_numpy()
    wanted.probe = None
    return wanted


def _blocks(width: int):
    def run(batches):
        ids, labels, vectors = [], [], []
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                part = batch.slice(a, BLOCK)
                if len(ids) + len(part) > BLOCK:
                    yield _block(ids, labels, vectors)
                    ids, labels, vectors = [], [], []
                ids += part.column(0).to_pylist()
                labels += part.column(1).to_pylist()
                vectors.append(dense(part.column(2), width).astype(np.int32).tobytes())
        if ids:
            yield _block(ids, labels, vectors)

    return run


def _block(ids, labels, vectors) -> pa.RecordBatch:
    return pa.record_batch({"ids": pa.array([ids], pa.list_(pa.int64())), "labels": pa.array([labels], pa.list_(pa.int64())), "vectors": pa.array([b"".join(vectors)], pa.binary())})


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector that is null, has a null or non-finite component, or is too long."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    short = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0))) < MOST_LENGTH
    return F.when(good & short, scaled)


def mine(
    rows: DataFrame, anchors: str | Column, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
) -> DataFrame:
    """Hard negatives of every row that fulfils ``anchors``: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Positives are the anchor's first ``positives`` rows of its label with another id, by falling score and rising
    id; negatives the first ``negatives`` rows of other labels with a score from ``low`` to ``high`` percent of the
    positive's. Rows take no part if their label or vector is null, or a component is null or not finite, or the
    squared length of the scaled vector reaches ``MOST_LENGTH``. A shorter vector counts as filled up with zeros.
    Null ids rank last and are never one another's id. Every row that is there twice counts twice, also as an
    anchor. Labels are whole numbers. Other columns are not read; an empty table gives no row.
    """
    spark = rows.sparkSession
    asked = F.expr(anchors) if isinstance(anchors, str) else anchors
    named = rows.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"), (F.col(f"`{label}`") if isinstance(label, str) else label).cast("bigint").alias("label"),
        integers(F.col(f"`{vector}`"), scale).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"),
    ).filter("label IS NOT NULL AND vector IS NOT NULL")
    named = materialize(named, "vectors")
    index = Index(named)
    chosen = named.filter("asked").select("id", "label", "vector")
    n = chosen.count()
    if index.tree is None or not n:
        return spark.createDataFrame([], RESULT)
    blocks = materialize(chosen.coalesce(n // BLOCK + 1).mapInArrow(_blocks(index.width), "ids array<bigint>, labels array<bigint>, vectors binary"), "anchors")
    parts = []
    for block in blocks.toLocalIterator():
        ids = np.array([NO_ID if x is None else x for x in block.ids], np.int64)
        vectors = np.frombuffer(block.vectors, np.int32).reshape(len(ids), index.width).astype(np.int64)
        labels = np.array(block.labels, np.int64)
        wanted = _probed(index, Wanted(ids, labels, vectors, 1, positives, same=True), index.tree.route(vectors)[0])
        found = _best(_run(index, wanted), positives).select("anchor", "rank", "other", "score").toArrow()
        wanted = Wanted(ids, labels, vectors, positives, negatives, same=False)
        wanted.low[:], wanted.high[:] = NO_ID, NONE + 1  # no window where there is no positive
        at = (found["anchor"].to_numpy(), found["rank"].to_numpy() - 1)
        score = found["score"].to_numpy()
        wanted.slot_id[at], wanted.slot_score[at] = found["other"].fill_null(NO_ID).to_numpy(), score
        wanted.low[at], wanted.high[at] = -(-low * score // 100), high * score // 100
        wanted = _probed(index, wanted, _leaf_near(index.tree, vectors, wanted.high.max(axis=1)))
        path = scratch_path(spark, "negatives")
        _best(_run(index, wanted), negatives).write.parquet(path)
        parts.append(path)
    found = spark.read.parquet(*parts)
    return found.select("anchor_id", F.col("slot_id").alias("positive_id"), "rank", F.col("other").alias("negative_id"), F.col("slot_score").alias("positive_score"), F.col("score").alias("negative_score"))


def _leaf_near(tree: Tree, vectors: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The leaf whose split point scores closest to the wanted score."""
    best, leaf = np.full(len(vectors), np.inf), np.zeros(len(vectors), np.int64)
    for i in range(len(tree.paths)):
        off = np.abs(vectors.astype(float) @ tree.split_of(i).astype(float) - score)
        leaf[off < best], best = i, np.minimum(best, off)
    return leaf
