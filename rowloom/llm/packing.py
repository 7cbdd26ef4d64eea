"""Packing of documents into token windows by dynamic programming over their borders, in their order.

The documents of a partition make one stream of tokens. Windows may end where a document ends, where a
sentence ends, or after exactly ``window`` tokens (and every ``window`` tokens of a sentence that is longer).
A plan costs its padding, plus ``sentence_cost`` or ``word_cost`` for every window that ends inside a
document. The cheapest plan up to a border p is

    best[p] = cost(p) + min over borders q, p - window <= q < p, of best[q] + padding(p - q)

with padding(n) = window - n, or 0 where n is a power of two. Apart from those lengths the minimum is
window - p + min(best[q] + q), which a monotone queue keeps in constant time for each border; the few
borders a power of two away are found beforehand by binary search.

Partitions are packed each on its own, in runs of about ``RUN_TOKENS`` tokens: what follows the cheapest
end of a run's last window goes to the next run. So a task holds a run or one document, nothing is
exchanged, and a task that is repeated packs alike.
"""

from __future__ import annotations

import json
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.words import give_back, small_batches

WINDOW = 1024
END_ID = 0
# tokens of padding that are worth as much as a cut inside a document: after a sentence, anywhere else
SENTENCE_COST, WORD_COST = 2, 8
RUN_TOKENS = 1 << 20
# characters that are tokenised at once, and of a run without white space that is not left to tiktoken
CHUNK, LONG_RUN = 1 << 19, 1000
_PART_BITS = 33

# The byte-level split of texts, white space in Unicode, and ends of sentences.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？", "।", "؟", "\n")

_BORDER = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
_LONG = re.compile(f"[^{SPACE}]{{{LONG_RUN}}}")


class Encoder:
    """Token ids of texts, as the ``tokenizers`` library gives them for whole texts.

    A plain byte-level BPE file (merges in the order of their ids, no normalizer) is run by tiktoken, which
    gives the same ids several times faster; other files, and runs of characters without white space beyond
    ``LONG_RUN``, go to ``tokenizers``. Byte-level pre-tokenizers never join a character to white space
    after it, so a text may be cut before every run of white space.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.fast = _tiktoken(json.load(file))
        names = [self.slow.decode([i], skip_special_tokens=False) for i in range(self.slow.get_vocab_size())]
        self.ends = np.array([n.rstrip("\"'”’»)").endswith(SENTENCE_ENDS) for n in names])
        self.opens = np.array([n[:1].isspace() for n in names])

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _ids(self, text: str) -> np.ndarray:
        if self.fast is None or _LONG.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")

    def encode(self, text: str) -> np.ndarray:
        parts, at = [np.zeros(0, np.uint32)], 0
        while at < len(text):
            border = _BORDER.search(text, at + CHUNK)
            to = border.start() if border else len(text)
            parts.append(self._ids(text[at:to]))
            at = to
        return np.concatenate(parts)


def _tiktoken(made: dict):
    """The same vocabulary for tiktoken, or None where the file asks for more than byte-level BPE."""
    import tiktoken

    model, split = made["model"], made["pre_tokenizer"] or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    special = {t["content"]: t["id"] for t in made["added_tokens"]}
    plain &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"])
    if not plain or made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    # the printable stand-ins of bytes: printable Latin-1 stands for itself, all others follow from 256 on
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(kept)))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merged = [model["vocab"][m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
    if merged != sorted(merged) or len(merged) + 256 != len(ranks):
        return None
    return tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def borders(ids: np.ndarray, ends: np.ndarray, encoder: Encoder, window: int, sentence_cost: int, word_cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, from 0 to the last token, and what each costs. ``ends``: ends of documents."""
    after = np.flatnonzero(encoder.ends[ids[:-1]] & encoder.opens[ids[1:]]) + 1
    natural = np.unique(np.concatenate([[0], after, ends]))
    gaps = (np.diff(natural) - 1) // window
    inner = np.repeat(natural[:-1], gaps) + window * (np.arange(gaps.sum()) - np.repeat(np.cumsum(gaps) - gaps, gaps) + 1)
    full = natural + window
    places = np.unique(np.concatenate([natural, inner, full[full < len(ids)]]))
    cost = np.full(len(places), word_cost, np.int64)
    cost[np.searchsorted(places, after)] = sentence_cost
    cost[np.searchsorted(places, ends)] = 0
    return places, cost


def cheapest(places: np.ndarray, cost: np.ndarray, window: int, to_end: bool = True) -> tuple[list[int], int]:
    """Ends of the windows of a cheapest plan, the first of them 0, and what the plan costs.

    With ``to_end`` the plan reaches the last place; otherwise it ends at the cheapest place that is less
    than a window before it. Of equal plans the one with longer windows is taken.
    """
    links = []
    size = 1
    while size < window:
        before = np.searchsorted(places, places - size)
        hit = np.flatnonzero((before < len(places)) & (places[np.minimum(before, len(places) - 1)] == places - size))
        links.append(np.stack([hit, before[hit]]))
        size *= 2
    near = np.concatenate(links, axis=1)
    near = near[:, np.argsort(near[0], kind="stable")]
    near_at, near_from = [*near[0].tolist(), -1], near[1].tolist()
    at, price = places.tolist(), cost.tolist()
    best, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int, int]] = deque([(at[0], at[0], 0)])  # best + place, place, index; falling from the right
    link = 0
    for j in range(1, len(at)):
        p = at[j]
        while queue[0][1] < p - window:
            queue.popleft()
        value, _, origin = queue[0]
        value += window - p
        while near_at[link] == j:
            i = near_from[link]
            if best[i] < value:
                value, origin = best[i], i
            link += 1
        value += price[j]
        best[j], back[j] = value, origin
        key = value + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, p, j))
    last = len(at) - 1
    if not to_end:
        first = int(np.searchsorted(places, at[-1] - window, side="right"))
        last = min(range(max(first, 1), len(at)), key=lambda j: (best[j], -at[j]))
    plan, j = [], last
    while j:
        plan.append(at[j])
        j = back[j]
    return [at[0], *reversed(plan)], best[last]


class _Run:
    """Documents of a run with their tokens; the first of them may have begun in the run before."""

    def __init__(self) -> None:
        self.rows: list[pa.Array] = []
        self.ids: list[np.ndarray] = []
        self.tokens = self.sequences = 0
        self.begun = 0  # tokens of the first document that are packed already

    def add(self, row: pa.Array, ids: np.ndarray) -> None:
        self.rows.append(row)
        self.ids.append(ids)
        self.tokens += len(ids)

    def pieces(self, pack, final: bool):
        """Pack what is there, yield the pieces, and hold the rest for the next run."""
        rows, ids = pa.concat_arrays(self.rows), np.concatenate(self.ids)
        lengths = np.array([len(x) for x in self.ids], np.int64)
        ends = np.cumsum(lengths)
        cuts = np.array(pack(ids, ends, final), np.int64)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        first = self.sequences + (part << _PART_BITS)
        edge = np.unique(np.concatenate([cuts, ends[ends < cuts[-1]]]))
        begun = np.zeros(len(lengths), np.int64)
        begun[0] = self.begun
        # pieces with at most so many tokens at once: their bytes share one buffer with 32-bit offsets
        for low in range(0, len(edge) - 1, RUN_TOKENS // 64):
            some = edge[low : low + RUN_TOKENS // 64 + 1]
            start, length = some[:-1], np.diff(some)
            doc, sequence = np.searchsorted(ends, start, side="right"), np.searchsorted(cuts, start, side="right") - 1
            data = ids[some[0] : some[-1]].astype("<u4")
            offsets = (4 * (some - some[0])).astype(np.int32)
            yield pa.record_batch({
                "row": rows.take(pa.array(doc)), "start": start - (ends - lengths)[doc] + begun[doc], "length": length, "doc_tokens": (lengths + begun)[doc],
                "sequence_id": first + sequence, "offset": start - cuts[sequence],
                "ids": pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(data)]),
            })
        rest = int(np.searchsorted(ends, cuts[-1], side="right"))
        if rest < len(ends):
            gone = int(cuts[-1] - (ends[rest] - lengths[rest]))
            self.begun = gone + int(begun[rest])
            self.rows, self.ids = [rows.slice(rest)], [ids[cuts[-1] : ends[rest]].copy(), *self.ids[rest + 1 :]]
        else:
            self.rows, self.ids, self.begun = [], [], 0
        self.tokens = sum(map(len, self.ids))
        self.sequences += len(cuts) - 1
        give_back()


def _pack(path: str, window: int, sentence_cost: int, word_cost: int):
    def run(batches):
        encoder = Encoder.at(path)

        def pack(ids, ends, final):
            return cheapest(*borders(ids, ends, encoder, window, sentence_cost, word_cost), window, final)[0]

        held = _Run()
        for batch in batches:
            for i in range(len(batch)):
                held.add(batch.column(0).slice(i, 1), np.append(encoder.encode(batch.column(1)[i].as_py()), np.uint32(END_ID)))
                if held.tokens >= RUN_TOKENS:
                    yield from held.pieces(pack, False)
        while held.tokens:
            yield from held.pieces(pack, True)

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None, order_by: list[str | Column] | None = None,
    window: int = WINDOW, sentence_cost: int = SENTENCE_COST, word_cost: int = WORD_COST,
) -> DataFrame:
    """One row for each piece of a document: ``row`` (the columns in ``keep``, by default all), ``start``,
    ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``ids`` as little-endian
    unsigned 32-bit numbers.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A document's tokens are those of
    its whole text and then ``END_ID``; null and empty texts have that one alone. Documents follow each other
    as they stand in each partition, or by ``order_by``, which costs an exchange by range. Repeated rows are
    documents of their own, an empty table gives no row, and columns of any name may be kept, as they stay
    inside ``row``. A document of any length is cut into as many windows as it needs; a run of characters
    without white space is given to the tokenizer in one piece.
    """
    if window < 2:
        raise ValueError("a window holds two tokens or more")
    small_batches(docs.sparkSession)
    if order_by:
        docs = docs.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    result = T.StructType([rows.schema["row"], *[T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(_pack(tokenizer, window, sentence_cost, word_cost), result)


def padded_length(length: Column, window: int = WINDOW) -> Column:
    """Places that a sequence of so many tokens takes: a power of two takes no more than itself."""
    return F.when(F.bit_count(length) == 1, length).otherwise(F.lit(window).cast("bigint"))


def sequences(pieces: DataFrame, pad_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and padded ``ids`` of every sequence; at most a window meets in a group."""
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    unpacked = _numbers(F.aggregate(F.transform("parts", lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b)))
    size = padded_length(F.col("n_tokens"), window)
    return joined.select("sequence_id", "n_tokens", F.concat(unpacked, F.array_repeat(F.lit(pad_id).cast("bigint"), (size - F.col("n_tokens")).cast("int"))).alias("ids"))


def _numbers(data: Column) -> Column:
    """Little-endian unsigned 32-bit numbers of a byte string."""
    return F.transform(
        F.sequence(F.lit(0), (F.octet_length(data) / 4).cast("int") - 1),
        lambda i: F.conv(_swapped(F.hex(F.substring(data, i * 4 + 1, F.lit(4)))), 16, 10).cast("bigint"),
    )


def _swapped(digits: Column) -> Column:
    return F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])
