"""Language identification of mixed text: script ranges, word scores, Viterbi over languages.

Words are maximal runs of letters. A word's script (the block of its letters) leaves only the
languages that were seen with that script in training; the others cannot take the word. Each
language scores a word by the log probabilities of its character n-grams (hashed into a table of
fixed size). A Viterbi pass over the words of a text finds the labelling with the best total score
when every change of language costs ``switch``. Runs of one label are the text's spans.

The model is fitted on a bounded sample of labelled rows, about ``SAMPLE_ROWS`` whole texts for each
language, picked by a hash of the row. Its table holds languages x ``BUCKETS`` numbers, which bounds
what is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.tables import packed
from rowloom.llm.words import mix, slices, small_batches

UNKNOWN = "und"
SAMPLE_ROWS = 1500
BUCKETS = 1 << 15
SIZES = range(1, 5)
SWITCH = 12.0
# share of a language's training letters that a script needs to make the language a candidate
SCRIPT_SHARE = 0.002
RESULT = "struct<lang:string,score:double,spans:array<struct<lang:string,start:int,end:int>>>"
KIND = pa.struct([
    ("lang", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
])

# fixed values: first code point of a block, and its script
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
_BLOCK_START = np.array([a for a, _ in SCRIPT_RANGES])
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
_BLOCK_SCRIPT = [SCRIPTS.index(s) for _, s in SCRIPT_RANGES]
_WORD = re.compile(r"[^\W\d_]+")
_WORDS_SEEN = 200_000  # distinct words whose scores a task keeps before it starts afresh
_WORDS_AT_ONCE = 4096  # new words whose n-grams are in memory together


def script_of(word: str) -> int:
    """The script of most letters of the word; of equals, the first in block order."""
    if word.isascii():
        return SCRIPTS.index("latin")
    blocks = np.searchsorted(_BLOCK_START, [ord(c) for c in word], side="right") - 1
    found = [_BLOCK_SCRIPT[b] for b in blocks]
    return max(dict.fromkeys(found), key=found.count)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the character n-grams of words with their borders marked, and each one's word."""
    points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    value, parts, owners = points, [], []
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            value = value[:-1] * np.uint64(0x100000001B3) + points[n - 1 :]
        inside = owner[: len(value)] == owner[n - 1 :]
        parts.append(mix(value[inside] * np.uint64(8) + np.uint64(n)) % np.uint64(BUCKETS))
        owners.append(owner[: len(value)][inside])
    return np.concatenate(parts).astype(np.int64), np.concatenate(owners)


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # languages x buckets, log probability
    scripts: np.ndarray  # languages x scripts, candidate or not
    prior: np.ndarray


def words_of(text: str) -> list[re.Match]:
    return [m for m in _WORD.finditer(text.lower()) if m[0].isascii() or any(c.isalpha() for c in m[0])]


def _count(batches):
    """Rows (language, place, count): n-grams at 0 and up, scripts below 0."""
    for batch in batches:
        for at, to in slices(batch.column("text")):
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").slice(at, to - at).to_pylist(), batch.column("text").slice(at, to - at).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(m[0] for m in words_of(text))
            for lang, counted in seen.items():
                if not counted:
                    continue
                words, n = list(counted), np.array(list(counted.values()), dtype=np.int64)
                place, owner = grams(words)
                table = np.bincount(place, weights=n[owner], minlength=BUCKETS).astype(np.int64)
                letters = np.bincount([script_of(w) for w in words], weights=n * [len(w) for w in words], minlength=len(SCRIPTS)).astype(np.int64)
                place, script = np.flatnonzero(table), np.flatnonzero(letters)
                yield pa.record_batch({
                    "lang": pa.array([lang] * (len(place) + len(script)), pa.string()),
                    "place": np.concatenate([place, -1 - script]), "n": np.concatenate([table[place], letters[script]]),
                })


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from about ``sample_rows`` rows of each language; None when no row has text and language."""
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.xxhash64(f"`{text}`").alias("h"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per label of the model
    if not sizes:
        return None
    places = 1_000_000
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(places, -(-sample_rows * places // n)))])
    sample = rows.filter(F.pmod("h", F.lit(places)) < share[F.col("lang")])
    counted = sample.select("lang", "text").mapInArrow(_count, "lang string, place bigint, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # at most languages x (buckets + scripts) rows
    languages = sorted(set(got.column("lang").to_pylist()))
    if not languages:
        return None
    index = np.array([languages.index(x) for x in got.column("lang").to_pylist()])
    place, n = got.column("place").to_numpy(), got.column("n").to_numpy()
    table = np.zeros((len(languages), BUCKETS))
    scripts = np.zeros((len(languages), len(SCRIPTS)))
    table[index[place >= 0], place[place >= 0]] = n[place >= 0]
    scripts[index[place < 0], -1 - place[place < 0]] = n[place < 0]
    table = np.log((table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    total = sum(sizes.values())
    return Model(languages, table.astype(np.float32), allowed & (scripts > 0), np.log([sizes[x] / total for x in languages]))


class Labeller:
    """Labels of all words of a slice of texts at once."""

    def __init__(self, model: Model, switch: float) -> None:
        self.model, self.switch = model, switch
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        """Score rows of new words; a word that no language can take scores alike in all."""
        model = self.model
        place, owner = grams(words)
        score = np.stack([np.bincount(owner, weights=row[place], minlength=len(words)) for row in model.table], axis=1)
        allowed = model.scripts[:, [script_of(w) for w in words]].T
        best = np.where(allowed, score, -np.inf).max(axis=1, keepdims=True)
        score = np.where(allowed, np.maximum(score - np.where(np.isfinite(best), best, 0), -self.switch), -2 * self.switch)
        score[~allowed.any(axis=1)] = 0
        self.scores = np.concatenate([self.scores, score.astype(np.float32)])

    def label(self, texts: list[str | None], spans: bool) -> list[dict]:
        if len(self.index) > _WORDS_SEEN:
            self.index, self.scores = {}, self.scores[:0]
        index, known = self.index, len(self.index)
        matched, rows = [], []
        for text in texts:  # words become numbers text by text: their strings take many times the text's memory
            if spans:
                matches = words_of(text or "")
                matched.append([m.span() for m in matches])
                words = [m[0] for m in matches]
            else:
                words = _WORD.findall((text or "").lower())
                if text is not None and not text.isascii():
                    words = [w for w in words if w.isascii() or any(map(str.isalpha, w))]
            rows.append((np.array([index.setdefault(w, len(index)) for w in words], np.int32), np.array([len(w) for w in words], np.int32)))
        fresh = islice(index, known, None)
        while words := list(islice(fresh, _WORDS_AT_ONCE)):
            self._learn(words)
        paths = self._viterbi([r for r, _ in rows])
        out = []
        for i, (path, (_, letters)) in enumerate(zip(paths, rows, strict=True)):
            if not len(path):
                out.append({"lang": UNKNOWN, "score": 0.0, "spans": []})
                continue
            share = np.bincount(path, weights=letters, minlength=len(self.model.languages)) / letters.sum()
            best = int(share.argmax())
            labelled = []
            if spans:
                edges = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
                labelled = [{"lang": self.model.languages[path[a]], "start": matched[i][a][0], "end": matched[i][b - 1][1]} for a, b in zip(edges, edges[1:], strict=False)]
            out.append({"lang": self.model.languages[best], "score": float(share[best]), "spans": labelled})
        return out

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best paths; texts go side by side, word by word, longest first."""
        sizes = np.array([len(r) for r in rows])
        order = np.argsort(-sizes, kind="stable")
        live = np.searchsorted(-sizes[order], -np.arange(1, sizes.max(initial=0) + 1), side="right")  # texts with so many words
        if not len(live):
            return rows
        starts = np.concatenate([[0], np.cumsum(live)])
        word = np.empty(starts[-1], np.int32)
        for i, r in enumerate(order):
            word[starts[: sizes[r]] + i] = rows[r]
        scores, k = self.scores, len(self.model.languages)
        stay = np.empty((starts[-1], k), bool)
        top = np.empty(starts[-1], np.int16)
        value = np.broadcast_to(self.model.prior, (live[0], k)).astype(np.float32)
        for t, n in enumerate(live):
            a, b = starts[t], starts[t + 1]
            value = value[:n]
            best = value.argmax(axis=1)
            moved = value[np.arange(n), best] - (self.switch if t else 0)
            keep = value >= moved[:, None]
            stay[a:b], top[a:b] = keep, best
            value = np.where(keep, value, moved[:, None]) + scores[word[a:b]]
            if t + 1 == len(live) or live[t + 1] < n:
                done = n if t + 1 == len(live) else live[t + 1]
                last = value[done if t + 1 < len(live) else 0 : n].argmax(axis=1)
                for i, state in enumerate(last, start=0 if t + 1 == len(live) else done):
                    rows[order[i]] = np.full(sizes[order[i]], state, np.int16)
        label = np.empty(starts[-1], np.int16)
        state = np.zeros(live[0], np.int64)
        ended = 0
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            for i in range(ended, n):  # texts whose last word this is
                state[i] = rows[order[i]][0]
            ended = n
            a = starts[t]
            label[a : a + n] = state[:n]
            kept = stay[a : a + n][np.arange(n), state[:n]]
            state[:n] = np.where(kept, state[:n], top[a : a + n])
        for i, r in enumerate(order):
            if sizes[r]:
                rows[r] = label[starts[: sizes[r]] + i]
        return rows


def identify(text: Column, spark, model: Model | None, spans: bool = True, switch: float = SWITCH) -> Column:
    """``lang``, ``score`` (share of the letters that carry it) and labelled ``spans`` of a text column.

    ``und`` with score 0 for null, for texts without a letter, and for all texts without a model.
    Span ends are exclusive, in code points of the lower-cased text.
    """
    shared = spark.sparkContext.broadcast(model)
    small_batches(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(shared.value, switch) if shared.value is not None else None
        for texts in batches:
            if labeller is None:
                yield pa.array([{"lang": UNKNOWN, "score": 0.0, "spans": []}] * len(texts), type=KIND)
                continue
            parts = [pa.array(labeller.label(texts.slice(a, b - a).to_pylist(), spans), type=KIND) for a, b in slices(texts, 4 << 20)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=KIND)

    return F.arrow_udf(run, RESULT)(text)


def keep_identified(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Documents that are written in learned languages, one or several; those without any go.

    What goes are null texts and texts without a letter. Where no row of ``training`` has both a label and
    a text there is nothing to tell languages by, and every document stays. Columns and values stay as they are.
    """
    model = fit(training, text, lang)
    if model is None:
        return docs
    found = docs.select(packed(docs), identify(F.col(f"`{text}`"), docs.sparkSession, model, spans=False).alias("found"))
    return found.filter(F.col("found.lang") != UNKNOWN).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
