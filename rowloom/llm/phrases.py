"""Removal of repeated passages with Aho-Corasick automata over confirmed phrases.

A phrase is ``SIZE`` consecutive words; it is repeated when it also starts in a document with a smaller
id. Every word that a repeated phrase covers goes.

1. Whole texts that occur under several ids are told by their hashes: all but the least id repeat it.
2. Anchors: the least of the hashes of all ``GRAM``-word runs inside a phrase depends on the phrase alone,
   and neighbouring phrases mostly share it. Anchors (one for about five words) that occur under one id
   only rule out their phrases.
3. Confirmation: the remaining phrases are grouped by hash with their least and largest id. Those with two
   ids are repeated, and the least id keeps them.
4. Each document meets the phrases it repeats in a join. Tasks join neighbouring phrases to passages,
   compile automata over the passages of a bounded slice of documents (the shards; a word is one symbol)
   and stream the slice's documents through them, which finds every occurrence.

Minima are combined before each exchange, so a phrase in a third of all documents is a few rows per task.
Bit tables of fixed size keep rows that cannot matter out of the exchanges; the joins decide.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.sieve import bit_table, look_up, perhaps
from rowloom.llm.words import SPACED, Words, joined, slices, small_batches, split_words
from rowloom.operators.keys import apart
from rowloom.session import materialize

SIZE = 13
GRAM = 5
# words of one slice that can be characters of a text; more become numbers
CODE_POINTS = 0x110000 - 0x800 - 2
RESULT = "n_words bigint, n_removed bigint, kept binary, kept_sha256 string"


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every run of n values."""
    span = 1
    while span * 2 <= n:
        x = np.minimum(x[:-span], x[span:]) if len(x) > span else x[:0]
        span *= 2
    rest = n - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest and len(x) > rest else x[: max(len(x) - rest, 0)]


def _starts(words: Words, size: int) -> np.ndarray:
    """Words at which a phrase of one text begins."""
    if len(words.text) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[: len(words.text) - size + 1] == words.text[size - 1 :])


def _anchors(words: Words, at: np.ndarray, size: int, gram: int) -> np.ndarray:
    return sliding_least(joined(words.hash, gram), size - gram + 1)[at]


def _anchor_rows(size: int, gram: int):
    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                words = split_words(batch.column(1).slice(a, b - a), SPACED)
                at = _starts(words, size)
                anchor, text = _anchors(words, at, size, gram), words.text[at]
                fresh = np.ones(len(at), bool)
                fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                ids = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)
                yield pa.record_batch({"a": anchor[fresh].view(np.int64), "d": ids[text[fresh]]})

    return run


def _phrase_rows(size: int, gram: int, anchors, confirmed):
    """Rows (phrase, id, text key) of phrases that pass the bit tables given."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(2)):
                words = split_words(batch.column(2).slice(a, b - a), SPACED)
                at = _starts(words, size)
                at = at[look_up(anchors.value, _anchors(words, at, size, gram).view(np.int64))]
                phrase = joined(words.hash, size)[at].view(np.int64) if len(at) else np.zeros(0, np.int64)
                if confirmed is not None:
                    passed = look_up(confirmed.value, phrase)
                    at, phrase = at[passed], phrase[passed]
                text = words.text[at]
                ids, keys = (batch.column(i).slice(a, b - a).to_numpy(zero_copy_only=False)[text] for i in (0, 1))
                yield pa.record_batch({"h": phrase, "d": ids, "k": keys})

    return run


class Shard:
    """An automaton over the passages that documents of a slice repeat; words are symbols of the slice.

    A passage is a longest run of phrases that its document repeats. It carries the largest of their
    least ids: a document with a larger id repeats all of them.
    """

    def __init__(self, words: Words, size: int, phrase: np.ndarray, least: np.ndarray, ids: np.ndarray) -> None:
        at = _starts(words, size)
        hashes = joined(words.hash, size)[at].view(np.int64) if len(at) else np.zeros(0, np.int64)
        order = np.argsort(phrase, kind="stable")
        phrase, least = phrase[order], least[order]
        found = np.searchsorted(phrase, hashes)
        found[found == len(phrase)] = 0
        repeated = (phrase[found] == hashes) & (least[found] < ids[words.text[at]]) if len(phrase) else np.zeros(len(at), bool)
        at, least = at[repeated], least[found[repeated]] if len(phrase) else least
        # only words of repeated phrases are told apart; texts are parted by a symbol that is no word
        inside = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(inside, at, 1)
        np.add.at(inside, at + size, -1)
        inside = np.cumsum(inside[:-1]) > 0
        known, number = np.unique(words.hash[inside], return_inverse=True)
        self.place = np.arange(len(words.hash)) + words.text
        symbols = np.zeros(len(words.hash) + len(words.bounds) - 1, "<u4")
        symbols[self.place] = 1
        symbols[self.place[inside]] = number.astype(np.uint32) + 2
        if len(known) < CODE_POINTS:
            symbols[symbols >= 0xD800] += 0x800  # code points that are no characters
            self.symbols = symbols.tobytes().decode("utf-32-le")
            self.automaton = ahocorasick.Automaton()
        else:
            self.symbols = tuple(symbols.tolist())
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.owner = np.zeros(len(symbols), np.int64)
        self.owner[self.place] = ids[words.text]
        if len(at):
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(words.text[at]) > 0)]))
            tops = np.maximum.reduceat(least, begins)
            ends = at[np.concatenate([begins[1:], [len(at)]]) - 1] + size
            for a, b, top in zip(self.place[at[begins]].tolist(), (self.place[ends - 1] + 1).tolist(), tops.tolist(), strict=True):
                passage = self.symbols[a:b]
                seen = self.automaton.get(passage, None)
                if seen is None or top < seen[1]:
                    self.automaton.add_word(passage, (b - a, top))
            self.automaton.make_automaton()

    def covered(self) -> np.ndarray:
        """Which words lie in an occurrence of a passage that their document repeats."""
        cover = np.zeros(len(self.symbols) + 1, np.int64)
        if len(self.automaton):
            hits = np.array([(end + 1, n, top) for end, (n, top) in self.automaton.iter(self.symbols)], np.int64).reshape(-1, 3)
            hits = hits[hits[:, 2] < self.owner[hits[:, 0] - 1]]
            np.add.at(cover, hits[:, 0] - hits[:, 1], 1)
            np.add.at(cover, hits[:, 0], -1)
        return (np.cumsum(cover[:-1]) > 0)[self.place]


def _remove(size: int, with_text: bool):
    """Rows with their remaining words; columns: row, id, text, whole (all repeats), phrases."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts, 2 << 20):
                part = batch.slice(a, b - a)
                words = split_words(texts.slice(a, b - a), SPACED)
                first = words.first
                n = np.diff(first)
                whole = part.column("whole").to_numpy(zero_copy_only=False) & (n >= size)
                gone = whole[words.text] if len(words.text) else np.zeros(0, bool)
                lists = part.column("phrases")
                if lists.null_count < len(lists):
                    pairs = lists.flatten()
                    ids = part.column("id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                    gone = gone | Shard(words, size, pairs.field("h").to_numpy(), pairs.field("m").to_numpy(), ids).covered()
                data = words.data.tobytes()
                removed = np.bincount(words.text, weights=gone, minlength=b - a).astype(np.int64)
                kept = []
                for i in range(b - a):
                    x, y = first[i], first[i + 1]
                    if removed[i] == 0:
                        kept.append(b" ".join(data[words.bounds[i] : words.bounds[i + 1]].split()))
                    else:
                        stays = np.flatnonzero(~gone[x:y]) + x
                        kept.append(b" ".join([data[s:e] for s, e in zip(words.start[stays].tolist(), words.end[stays].tolist(), strict=True)]))
                yield pa.record_batch({
                    "row": part.column("row"), "n_words": n, "n_removed": removed, "kept": pa.array(kept if with_text else [None] * (b - a), pa.binary()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                })

    return run


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, size: int = SIZE, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """``row`` with ``n_words``, ``n_removed``, ``kept`` (remaining words joined by a space) and ``kept_sha256``.

    A null text has no words. A null id is neither smaller nor larger than another: such rows lose nothing
    and take nothing. Rows with equal ids take nothing from each other; repeated rows get equal results. A text
    is one piece of work whatever its length and number of distinct words.
    """
    small_batches(docs.sparkSession)
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]).alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    named = named.withColumns({"th": F.xxhash64("text"), "check": F.xxhash64(F.lit(1), "text"), "k": F.xxhash64("id", "text")})
    twice = named.filter("id IS NOT NULL").groupBy("th", "check").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    twice = materialize(twice, "copies")
    copied = bit_table(twice, "th")
    split = named.withColumn("twice", perhaps(copied, F.col("th")))
    single = split.filter(~F.col("twice")).select("row", "id", "text", "k", F.lit(False).alias("whole"))
    lead = twice.select(apart("th").alias("t"), F.col("check").alias("c"), "least")
    joined_to = split.filter("twice").join(lead, (F.col("th") == F.col("t")) & (F.col("check") == F.col("c")), "left")
    copies = joined_to.select("row", "id", "text", "k", F.coalesce(F.col("least") < F.col("id"), F.lit(False)).alias("whole"))
    # later copies need no phrases of their own; the join decides which rows these are
    first = materialize(copies.filter("id IS NOT NULL AND NOT whole").select("id", "k", "text"), "first-copies")
    once = single.filter("id IS NOT NULL").select("id", "k", "text").union(first)
    anchors = once.select("id", "text").mapInArrow(_anchor_rows(size, gram), "a bigint, d bigint")
    anchors = anchors.groupBy("a").agg(F.min("d").alias("least"), F.max("d").alias("most")).filter("least < most")
    anchors = bit_table(materialize(anchors.select("a"), "anchors"), "a")
    phrases = once.mapInArrow(_phrase_rows(size, gram, anchors, None), "h bigint, d bigint, k bigint")
    phrases = phrases.groupBy("h").agg(F.min("d").alias("m"), F.max("d").alias("most")).filter("m < most")
    phrases = materialize(phrases.select("h", "m"), "phrases")
    occurring = once.mapInArrow(_phrase_rows(size, gram, anchors, bit_table(phrases, "h")), "h bigint, d bigint, k bigint").distinct()
    repeats = occurring.join(phrases.select(apart("h").alias("p"), "m"), (F.col("h") == F.col("p")) & (F.col("m") < F.col("d")))
    lists = repeats.groupBy("k").agg(F.collect_set(F.struct("h", "m")).alias("phrases"))  # no more than a text has words
    lists = materialize(lists, "phrases-by-text")
    every = single.union(copies)
    every = every.withColumn("listed", perhaps(bit_table(lists, "k"), F.col("k")) & ~F.col("whole"))
    columns = ["row", "id", "text", "whole"]
    with_phrases = every.filter("listed").join(lists.select(apart("k").alias("q"), "phrases"), F.col("k") == F.col("q"), "left").select(*columns, "phrases")
    without = every.filter(~F.col("listed")).select(*columns, F.lit(None).cast("array<struct<h:bigint,m:bigint>>").alias("phrases"))
    result = T.StructType([named.schema["row"], *T.StructType.fromDDL(RESULT).fields])
    return without.union(with_phrases).mapInArrow(_remove(size, with_text), result)
