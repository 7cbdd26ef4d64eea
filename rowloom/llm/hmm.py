"""A hidden Markov language model, trained by Baum-Welch and scored by the scaled forward recursion.

Words map to classes: the ``WORDS`` most frequent training words, one class for all others, and the end of
a text. Hidden states emit classes; a word of the common class has its probability among those words by
add-half counts, so a text's probability is that of its class sequence times those of its rare words.

Each round of Baum-Welch runs over all training texts: tasks compute expected starts, transitions and
emissions of their texts, and the sums over all tasks make the next model. The first guess are the word
counts of all training texts, shaken by fixed random factors. Texts of like length lie together, so that
the recursions step through many of them at once, in files of about ``PART_TOKENS`` tokens each.

Counts of all training words stay a table. Tasks hold the counts of at most ``LOOKUP`` frequent words;
the other words of a text are joined with the table, so every count is exact whatever the vocabulary.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.words import SPACED_LOWER, slices, small_batches, split_words
from rowloom.session import materialize

STATES = 8
WORDS = 4094
LOOKUP = 1 << 18
ROUNDS = 14
SCALED = 4  # steps from one scaling to the next
SLICE_TOKENS = 1 << 20
WIDTH = 2048  # sequences side by side, so that a step's arrays stay in the cache
PART_TOKENS = 4 << 20
SLOTS = 1 << 20
ENCODED = "training boolean, n_tokens bigint, n_known bigint, log_known double, n_rare bigint, log_rare double, codes binary, rest array<bigint>, rest_n array<int>"


class Counts(NamedTuple):
    """Frequent words by hash with their counts, and totals over all training words."""

    hash: np.ndarray
    count: np.ndarray
    code: np.ndarray  # class of each, ``rare`` for those beyond the most frequent
    n_texts: int
    tokens: int
    distinct: int
    rare: int
    end: int
    rare_tokens: int
    rare_distinct: int


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes


def _count(batches):
    """Rows (word hash, count), summed over a batch."""
    for batch in batches:
        texts = batch.column(0)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for at, to in slices(texts):
            parts.append(np.unique(split_words(texts.slice(at, to - at), SPACED_LOWER).hash, return_counts=True))
        value, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(value)).astype(np.int64)
        yield pa.record_batch({"h": value.view(np.int64), "c": n})


def count_words(texts: DataFrame) -> DataFrame:
    """(h, c) of every word of a one-column table of texts."""
    return materialize(texts.mapInArrow(_count, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")), "word-counts")


def frequent(counts: DataFrame, n_texts: int) -> Counts:
    """The most frequent words, as many as ``LOOKUP`` allows without parting words of equal count."""
    least = sorted({int(2 ** (k / 4)) for k in range(4 * 45)})
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), *[F.count(F.when(F.col("c") >= x, 1)).alias(f"c{x}") for x in least]).first()
    cut = next(x for x in least if row[f"c{x}"] <= LOOKUP)
    got = counts.filter(F.col("c") >= cut).toArrow()
    h, c = got.column("h").to_numpy().astype(np.int64).view(np.uint64), got.column("c").to_numpy().astype(np.int64)
    order = np.lexsort((h, -c))
    code = np.full(len(h), min(WORDS, len(h)), np.int64)
    code[order[:WORDS]] = np.arange(min(WORDS, len(h)))
    by_hash = np.argsort(h)
    top = int(c[order[:WORDS]].sum())
    rare = min(WORDS, len(h))
    return Counts(h[by_hash], c[by_hash], code[by_hash], n_texts, row.n + n_texts, row.v + (n_texts > 0), rare, rare + 1, row.n - top, row.v - rare)


class Finder:
    """Places of values in a sorted array: at once where a value has its slot, by search for the others."""

    def __init__(self, values: np.ndarray, weights: np.ndarray) -> None:
        self.values = values
        order = np.argsort(weights, kind="stable")  # the heaviest value keeps a slot that several share
        self.slot = np.zeros(SLOTS, np.int32)
        self.slot[self._of(values[order])] = order

    def _of(self, values: np.ndarray) -> np.ndarray:
        return (values & np.uint64(SLOTS - 1)).astype(np.int64)

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each value, and whether it is there."""
        if not len(self.values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        place = self.slot[self._of(values)].astype(np.int64)
        known = self.values[place] == values
        missed = np.flatnonzero(~known)
        found = np.searchsorted(self.values, values[missed])
        found[found == len(self.values)] = 0
        place[missed] = found
        known[missed] = self.values[found] == values[missed]
        return place, known


def _encode(shared, n_row: int):
    def run(batches):
        counts = shared.value
        find, worth_of = Finder(counts.hash, counts.count), np.log10(counts.count + 0.5)
        for batch in batches:
            texts = batch.column(n_row)
            for at, to in slices(texts):
                size = to - at
                words = split_words(texts.slice(at, size), SPACED_LOWER)
                place, known = find(words.hash)
                code = np.full(len(place), counts.rare)
                code[known] = counts.code[place[known]]
                worth = np.zeros(len(place))
                worth[known] = worth_of[place[known]]
                rare = code == counts.rare
                add = lambda w, t=words.text, size=size: np.bincount(t, weights=w, minlength=size).astype(float)
                first = words.first
                coded = np.insert(code, first[1:], counts.end).astype("<u2").tobytes()
                ends = 2 * (first + np.arange(size + 1))
                # distinct words beyond the lookup, with their number
                order = np.lexsort((words.hash[~known], words.text[~known]))
                text, value = words.text[~known][order], words.hash[~known][order]
                fresh = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (value[1:] != value[:-1])])) if len(text) else np.zeros(0, np.int64)
                n = np.diff(np.concatenate([fresh, [len(text)]])).astype(np.int32)
                offsets = pa.array(np.searchsorted(text[fresh], np.arange(size + 1)).astype(np.int32))
                yield pa.record_batch({
                    **{f: batch.column(i).slice(at, size) for i, f in enumerate(("row", "training"))},
                    "n_tokens": np.diff(first) + 1, "n_known": add(known).astype(np.int64) + (counts.n_texts > 0),
                    "log_known": add(worth) + np.log10(counts.n_texts + 0.5), "n_rare": add(rare).astype(np.int64), "log_rare": add(worth * rare),
                    "codes": pa.array([coded[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                    "rest": pa.ListArray.from_arrays(offsets, pa.array(value[fresh].view(np.int64))), "rest_n": pa.ListArray.from_arrays(offsets, pa.array(n)),
                })

    return run


class Layout:
    """Class sequences side by side: the t-th tokens of all texts that have one are neighbours."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        sizes = np.array([len(r) for r in rows])
        self.order = np.argsort(-sizes, kind="stable")
        self.live = np.searchsorted(-sizes[self.order], -np.arange(1, sizes.max(initial=0) + 1), side="right")
        self.at = np.concatenate([[0], np.cumsum(self.live)])
        self.code = np.empty(self.at[-1], np.int64)
        for i, r in enumerate(self.order):
            self.code[self.at[: sizes[r]] + i] = rows[r]


def forward(model: Model, rows: list[np.ndarray], keep: bool = False):
    """Natural log of each sequence's probability; with ``keep`` also the layout, scaled forwards and scales by step.

    States are rows, so that each operation runs along the texts. Emissions are relative to the likeliest
    state of their class, which keeps ``SCALED`` steps far from underflow.
    """
    layout = Layout(rows)
    most = model.emit.max(axis=0)
    emit, worth, move = model.emit / most, np.log(most), np.ascontiguousarray(model.move.T)
    total = np.zeros(len(rows))
    alphas = np.empty((len(model.start), layout.at[-1] if keep else 0))
    scales = {}
    alpha = np.ones((len(model.start), len(rows))) / len(model.start)
    for t, n in enumerate(layout.live):
        a, b = layout.at[t], layout.at[t + 1]
        code = layout.code[a:b]
        if n < alpha.shape[1]:
            total[n : alpha.shape[1]] += np.log(alpha[:, n:].sum(axis=0))
        seen = emit.take(code, axis=1)
        out = alphas[:, a:b] if keep else np.empty(seen.shape)
        if t:
            np.matmul(move, alpha[:, :n], out=out)
            out *= seen
        else:
            np.multiply(model.start[:, None], seen, out=out)
        total[:n] += worth.take(code)
        if t % SCALED == 0:
            scales[t] = out.sum(axis=0)
            out /= scales[t]
            total[:n] += np.log(scales[t])
        alpha = out
    total[: alpha.shape[1]] += np.log(alpha.sum(axis=0))
    logs = np.empty(len(rows))
    logs[layout.order] = total
    return (logs, layout, alphas, scales) if keep else logs


def expect(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """Expected starts, transitions and emissions of the sequences, and their log probability, in one vector."""
    states, classes = model.emit.shape
    logs, layout, gamma, scales = forward(model, rows, keep=True)
    emit, move = model.emit / model.emit.max(axis=0), np.ascontiguousarray(model.move)
    beta = np.empty((states, len(rows)))
    moves = np.zeros((states, states))
    ended = 0
    for t in range(len(layout.live) - 1, -1, -1):
        n, a, b = layout.live[t], layout.at[t], layout.at[t + 1]
        alpha = gamma[:, a:b]
        if n > ended:
            beta[:, ended:n] = 1 / alpha[:, ended:].sum(axis=0)
            ended = n
        if t:
            weighted = emit.take(layout.code[a:b], axis=1)
            weighted *= beta[:, :n]
            if t in scales:
                weighted /= scales[t]
            before = layout.at[t - 1]
            moves += gamma[:, before : before + n] @ weighted.T
        alpha *= beta[:, :n]
        if t:
            np.matmul(move, weighted, out=beta[:, :n])
    emits = np.stack([np.bincount(layout.code, weights=g, minlength=classes) for g in gamma])
    starts = gamma[:, : layout.live[0]].sum(axis=1) if len(layout.live) else np.zeros(states)
    return np.concatenate([starts, (moves * model.move).ravel(), emits.ravel(), [logs.sum()]])


def _sequences(codes: pa.Array):
    """Lists of at most WIDTH class sequences, with at most SLICE_TOKENS tokens and one sequence more."""
    sizes = pc.binary_length(codes).to_numpy(zero_copy_only=False)
    total = int(sizes.sum())
    for at, to in slices(codes, total // max(1, -(-total // (2 * SLICE_TOKENS))) + int(sizes.max(initial=0))):
        for low in range(at, to, WIDTH):
            yield low, [np.frombuffer(c.as_buffer(), "<u2").astype(np.int64) for c in codes.slice(low, min(WIDTH, to - low))]


def _expectations(shared):
    def run(batches):
        total = None
        for batch in batches:
            for _, rows in _sequences(batch.column(0)):
                found = expect(shared.value, rows)
                total = found if total is None else total + found
        if total is not None:
            place = np.flatnonzero(total)
            yield pa.record_batch({"i": place, "v": total[place]})

    return run


def _model(total: np.ndarray, states: int, prior: np.ndarray) -> Model:
    start, move, emit = np.split(total, [states, states + states * states])
    start, move, emit = start + 1, move.reshape(states, states) + 1, emit.reshape(states, -1) + prior
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def guess(counts: Counts, states: int = STATES, seed: int = 11) -> tuple[Model, np.ndarray]:
    """A first model around the add-half distribution of the classes, and that distribution."""
    classes = counts.end + 1
    share = np.full(classes, 0.5)
    np.add.at(share, counts.code, np.where(counts.code == counts.rare, 0, counts.count))
    share[counts.rare] += max(counts.rare_tokens, 0)
    share[counts.end] += counts.n_texts
    share /= share.sum()
    rng = np.random.default_rng(seed)
    emit = share * np.exp(rng.normal(0, 0.5, (states, classes)))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)), share


def _by_length(rows: DataFrame) -> DataFrame:
    """Rows by rising length in parts of about PART_TOKENS tokens: a part of long texts holds fewer of them."""
    level = F.floor(16 * F.log2("n_tokens")).cast("int")
    found = rows.groupBy(level.alias("level")).agg(F.sum("n_tokens").alias("n")).collect()
    size = np.zeros(max((r.level for r in found), default=0) + 1)
    size[[r.level for r in found]] = [r.n for r in found]
    parts = max(1, round(size.sum() / PART_TOKENS))
    before, size = (F.get(F.lit(x.tolist()), level) for x in ((np.cumsum(size) - size) / max(size.sum(), 1), size / max(size.sum(), 1)))
    # texts of one level are dealt out over the parts that the level takes up
    share = F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) / float(1 << 20)
    part = F.least(F.floor((before + share * size) * parts), F.lit(parts - 1)).cast("int")
    return rows.repartitionById(parts, part).sortWithinPartitions("n_tokens", "rid")


def fit(encoded: DataFrame, counts: Counts, states: int = STATES, rounds: int = ROUNDS, seed: int = 11) -> Model:
    """A model of the rows with ``training``, all of them in each round; without any, the first guess."""
    spark = encoded.sparkSession
    model, share = guess(counts, states, seed)
    if not counts.n_texts:
        return model
    training = materialize(_by_length(encoded.filter("training")).select("codes"), "training")
    prior = share * 0.5  # half a word of the overall distribution in each state
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        sums = training.mapInArrow(_expectations(shared), "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(states + states * states + model.emit.size + 1)
        total[sums.column("i").to_numpy()] = sums.column("v").to_numpy()
        model = _model(total[:-1], states, prior)
        shared.unpersist()
    return model


def _score(shared):
    def run(codes: pa.Array) -> pa.Array:
        parts = [forward(shared.value, rows) / np.log(10) for _, rows in _sequences(codes)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run


def score_texts(docs: DataFrame, training: Column, text: str = "text", keep: list[str] | None = None, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``row`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of each text.

    ``training`` says which rows the model learns from; null means no. Words are lower-cased (A-Z) and
    parted by ASCII white space; a null text has only its end. ``base_score`` is the add-half unigram score.
    """
    spark = docs.sparkSession
    small_batches(spark)
    training = F.coalesce(training, F.lit(False))
    text_column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counted = count_words(docs.filter(training).select(text_column.alias("text")))
    counts = frequent(counted, docs.filter(training).count())
    row = F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)])
    rows = docs.select(row.alias("row"), training.alias("training"), text_column.alias("text"))
    kinds = T.StructType([rows.schema["row"], *T.StructType.fromDDL(ENCODED).fields])
    encoded = rows.mapInArrow(_encode(spark.sparkContext.broadcast(counts), 2), kinds)
    encoded = materialize(encoded.withColumn("rid", F.monotonically_increasing_id()), "encoded")
    model = fit(encoded, counts, states, rounds)
    rest = encoded.filter(F.size("rest") > 0).select("rid", F.explode(F.arrays_zip("rest", "rest_n")).alias("w")).select("rid", F.col("w.rest").alias("h"), F.col("w.rest_n").alias("k"))
    found = rest.join(counted, "h").groupBy("rid").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("c") + 0.5)).alias("worth"))
    joined = encoded.drop("rest").join(found, "rid", "left")
    k, worth = F.coalesce("k", F.lit(0)), F.coalesce("worth", F.lit(0.0))
    unseen = (F.col("n_tokens") - F.col("n_known") - k) * float(np.log10(0.5)) if counts.n_texts else F.col("n_tokens") * float(np.log10(0.5)) - F.lit(float(np.log10(0.5)))
    base = F.col("log_known") + worth + unseen - F.col("n_tokens") * float(np.log10(counts.tokens + 0.5 * (counts.distinct + 1)))
    rare = F.col("log_rare") + worth + unseen - F.col("n_rare") * float(np.log10(counts.rare_tokens + 0.5 * (counts.rare_distinct + 1)))
    sequence = F.arrow_udf(_score(spark.sparkContext.broadcast(model)), "double")("codes")
    return joined.select("row", "training", "n_tokens", (F.col("n_known") + k).alias("n_known"), F.lit(counts.tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), (sequence + rare).alias("score"))
