"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised (A-Z lower-cased, words of ASCII letters, digits and all that is beyond ASCII).
All items go into one suffix automaton over word numbers; document words are streamed through it and
the longest match that ends at each word is tracked. A match of at least ``window`` words is a leak:
every run of ``window`` words in it is a run of some item. Items shorter than the window leak as a
whole. Long documents cost little: a word run can only reach the limit where each pair of neighbours
is a pair of some item, which is looked up for all words at once before the automaton is stepped.

Items are split over automata of at most ``shard_words`` words each, so the driver builds and
broadcasts one at a time. A slice of texts goes through all of them in one step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.tables import packed
from rowloom.llm.words import ALNUM_LOWER, slices, small_batches, split_words

WINDOW = 10
SHARD_WORDS = 50_000
RESULT = "struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<string>>"
KIND = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
CUT_RESULT = f"struct<leak:{RESULT},clean:string>"
CUT_KIND = pa.struct([("leak", KIND), ("clean", pa.string())])


class SuffixAutomaton:
    """All runs of words of a set of items, and the items of each window."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        self.window = window
        self.vocabulary = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.windows: dict[tuple[int, ...], set[str]] = {}
        pairs = [np.zeros(0, np.int64)]
        for item, hashes in items:
            numbers = np.searchsorted(self.vocabulary, hashes)
            pairs.append(numbers[:-1] * len(self.vocabulary) + numbers[1:])
            numbers = numbers.tolist()
            last = 0
            for number in numbers:
                last = self._extend(last, number)
            size = min(window, len(numbers))
            for i in range(len(numbers) - size + 1):
                self.windows.setdefault(tuple(numbers[i : i + size]), set()).add(item)
        self.pairs = np.unique(np.concatenate(pairs))
        self.sizes = sorted({len(w) for w in self.windows})

    def _new(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, child: int, number: int) -> int:
        """The state for child's runs no longer than state's plus one."""
        if self.length[child] == self.length[state] + 1:
            return child
        copy = self._new(self.length[state] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while state != -1 and self.next[state].get(number) == child:
            self.next[state][number] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, number: int) -> int:
        if number in self.next[last]:
            return self._split(last, self.next[last][number], number)
        state = self._new(self.length[last] + 1, {}, 0)
        while last != -1 and number not in self.next[last]:
            self.next[last][number] = state
            last = self.link[last]
        if last != -1:
            self.link[state] = self._split(last, self.next[last][number], number)
        return state

    def stream(self, numbers: list[int], found: set[str]) -> list[tuple[int, int]]:
        """Ranges of the words that lie in an occurrence of a window."""
        state = length = 0
        hits: list[tuple[int, int]] = []
        for i, number in enumerate(numbers):
            while state and number not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if number in self.next[state]:
                state = self.next[state][number]
                length += 1
            for size in self.sizes:
                if size > length:
                    break
                items = self.windows.get(tuple(numbers[i - size + 1 : i + 1]))
                if items:
                    found |= items
                    # all of a match of window length or more is made of windows
                    hits.append((i - (length if size == self.window else size) + 1, i + 1))
        return hits

    def scan(self, texts: pa.Array) -> list[dict]:
        """Leaking word ranges and items of each text."""
        words = split_words(texts, ALNUM_LOWER)
        first = words.first
        out = [{"n_words": int(b - a), "starts": [], "ends": [], "items": []} for a, b in zip(first, first[1:], strict=False)]
        if not len(self.vocabulary) or not len(words.hash):
            return out
        number = np.searchsorted(self.vocabulary, words.hash)
        number[number == len(self.vocabulary)] = 0
        known = self.vocabulary[number] == words.hash
        linked = known[:-1] & known[1:] & (words.text[:-1] == words.text[1:])
        pair = number[:-1] * len(self.vocabulary) + number[1:]
        at = np.searchsorted(self.pairs, pair[linked])
        at[at == len(self.pairs)] = 0
        linked[linked] = self.pairs[at] == pair[linked] if len(self.pairs) else False
        # runs of linked words; a run of one word counts only where an item is one word long
        begins = np.flatnonzero(known & np.concatenate([[True], ~linked]))
        ends = np.flatnonzero(known & np.concatenate([~linked, [True]])) + 1
        enough = ends - begins >= self.sizes[0]
        if self.sizes[0] == 1:
            single = np.array(sorted(w[0] for w in self.windows if len(w) == 1))
            rest = [s for s in self.sizes if s > 1]
            enough = (ends - begins >= (rest[0] if rest else 1 << 60)) | np.isin(number[begins], single) | (ends - begins > 1)
        hits: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for a, b in zip(begins[enough].tolist(), ends[enough].tolist(), strict=True):
            text = int(words.text[a])
            if found := self.stream(number[a:b].tolist(), items.setdefault(text, set())):
                hits.setdefault(text, []).extend((a - int(first[text]) + x, a - int(first[text]) + y) for x, y in found)
        for text, ranges in hits.items():
            merged = merge(ranges)
            out[text] |= {"starts": [a for a, _ in merged], "ends": [b for _, b in merged], "items": sorted(items[text])}
        return out


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges as few as cover the same words; touching ranges become one."""
    merged: list[list[int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def _shards(items: DataFrame, item_id: str, text: str, shard_words: int):
    """Items in lists of at most ``shard_words`` words; a longer item is a list of its own.

    Read one partition at a time; only the list at hand is kept.
    """
    rows = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").alias("t"))
    held, size = [], 0
    for row in rows.filter(F.length("t") > 0).toLocalIterator():
        hashes = split_words(pa.array([row.t]), ALNUM_LOWER).hash
        if held and size + len(hashes) > shard_words:
            yield held
            held, size = [], 0
        if len(hashes):
            held.append((row.i, hashes))
            size += len(hashes)
    yield held


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Documents as ``row`` with ``leak``: words, leaking word ranges and the ids of the leaked items.

    Null or empty texts have no words. Null item ids count as the id ''. Items that repeat count
    once for each different id. Without items nothing leaks.
    """
    return _scanned(docs, items, text, item_id, item_text, window, shard_words, cut=False)


def _scanned(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, shard_words: int, cut: bool) -> DataFrame:
    """``row``, ``text`` and ``leak``; with ``cut`` also ``clean``, the text without its leaks, null where it has none.

    One step scans and cuts: every step in Python has a worker of its own in each task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    automata = [spark.sparkContext.broadcast(SuffixAutomaton(held, window)) for held in _shards(items, item_id, item_text, shard_words)]
    # a filter on a deterministic function's result would move below it and run it twice
    scan = F.arrow_udf(_scanner(automata, cut), CUT_RESULT if cut else RESULT).asNondeterministic()
    out = docs.select(packed(docs), F.col(f"`{text}`").alias("text"), scan(F.col(f"`{text}`")).alias("leak"))
    return out.select("row", "text", "leak.leak", "leak.clean") if cut else out


def _joined(old: dict, new: dict) -> dict:
    """What two automata found in one text."""
    both = merge([*zip(old["starts"], old["ends"], strict=True), *zip(new["starts"], new["ends"], strict=True)])
    return new | {"starts": [a for a, _ in both], "ends": [b for _, b in both], "items": sorted({*old["items"], *new["items"]})}


def _scanner(automata: list, cut: bool):
    """Texts go through all automata, slice by slice."""

    def scan(texts: pa.Array) -> pa.Array:
        kind = CUT_KIND if cut else KIND
        parts = []
        for at, to in slices(texts):
            part = texts.slice(at, to - at)
            found = automata[0].value.scan(part)
            for shared in automata[1:]:
                found = [_joined(old, new) for old, new in zip(found, shared.value.scan(part), strict=True)]
            if cut:
                found = [{"leak": f, "clean": _cut(t.as_py(), f["starts"], f["ends"]) if f["starts"] else None} for t, f in zip(part, found, strict=True)]
            parts.append(pa.array(found, type=kind))
        return pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    return scan


def _cut(text: str, starts: list[int], ends: list[int]) -> str:
    words = split_words(pa.array([text]), ALNUM_LOWER, hashed=False)
    data, kept, at = words.data.tobytes(), [], 0
    for i, j in zip(starts, ends, strict=True):
        kept.append(data[at : words.start[i]])
        at = words.end[j - 1]
    return b"".join([*kept, data[at:]]).decode()


def remove_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, max_coverage: float = 0.5, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Documents with leaking spans cut out; those that leak in over ``max_coverage`` of their words go.

    Same columns as ``docs``. A document without leaks keeps its text unchanged, null included.
    """
    found = _scanned(docs, items, text, item_id, item_text, window, shard_words, cut=True)
    n_hit = F.aggregate(F.zip_with("leak.starts", "leak.ends", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
    kept = found.filter(n_hit <= F.col("leak.n_words") * max_coverage)
    clean = F.when(F.size("leak.starts") == 0, F.col("text")).otherwise(F.col("clean"))
    cleaned = kept.select("row", clean.alias("clean"))
    return cleaned.select(*[F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
