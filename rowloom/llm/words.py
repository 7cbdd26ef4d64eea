"""Vectorised word splitting and hashing of Arrow text columns.

A batch of texts is one byte buffer. Word borders come from a table over byte values, word hashes
from a prefix sum of a polynomial over the bytes, so no Python object is made per word. UTF-8 keeps
ASCII bytes apart from all others, which makes byte classes exact for the word rules used here.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# bytes of text that are worked on at once; a single longer text is a slice of its own
SLICE_BYTES = 2 << 20
PIECE_BYTES = 1 << 18
# bytes that Spark hands to Python at once, by a setting of the session
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

_LIBC = ctypes.CDLL(None)
_M_MMAP_THRESHOLD, _LARGE = -3, 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers[:] = made
    return _powers


class Rule(NamedTuple):
    """Which bytes make words, and what each byte counts as."""

    inside: np.ndarray
    fold: np.ndarray


def _rule(inside: Callable[[int], bool], lower: bool) -> Rule:
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    return Rule(np.array([inside(int(fold[b])) for b in range(256)]), fold)


# words without ASCII white space, as they are or with A-Z lower-cased
SPACED = _rule(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D, lower=False)
SPACED_LOWER = _rule(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D, lower=True)
# lower-cased ASCII letters, digits and everything beyond ASCII
ALNUM_LOWER = _rule(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A, lower=True)


class Words(NamedTuple):
    """Words of a slice in order: text number, byte range in the buffer, hash."""

    data: np.ndarray
    bounds: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of each text, and the count of words at the end."""
        return np.searchsorted(self.text, np.arange(len(self.bounds)))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; a null is an empty text."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, rule: Rule, hashed: bool = True) -> Words:
    data, bounds = text_bytes(texts)
    inside = rule.inside[data]
    before = np.empty(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[:-1] = inside[1:]
    if len(data):
        before[0] = after[-1] = False
    edges = bounds[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    text = (np.searchsorted(bounds, start, side="right") - 1).astype(np.int32)
    return Words(data, bounds, text, start, end, _hashes(data, start, end, rule) if hashed else np.zeros(0, np.uint64))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    values = _BYTE_VALUE[rule.fold]
    at = 0
    while at < len(start):
        # whole words only: up to the last word that ends within the piece, one at least
        to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE_BYTES, side="right")))
        low = start[at]
        size = int(end[to - 1] - low)
        power, inverse = _power_tables(max(size + 1, PIECE_BYTES + 1))
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[data[low : low + size]] * power[:size], out=total[1:])
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words; the last runs start n words before the end."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * 0xD6E8FEB86659FD93 & _MASK
        out += hashes[i : i + count] * np.uint64(factor)
    return mix(out)


def give_back() -> None:
    """Return the pages of freed arrays to the system; workers are used again and would keep them.

    From the first call on, large arrays go back at once when they are freed, also those of a task that ends.
    """
    if hasattr(_LIBC, "malloc_trim"):
        if pa.default_memory_pool().backend_name != "system":
            pa.set_memory_pool(pa.system_memory_pool())
            _LIBC.mallopt(_M_MMAP_THRESHOLD, _LARGE)
        _LIBC.malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Let texts go to Python in batches of about ``BATCH_BYTES``, unless the session has a size of its own.

    A batch exists on both sides of the pipe at once. The size alters no result.
    """
    if spark.conf.get(BATCH_CONF, "1") == "1":
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes of text, or one row; memory is given back after each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield at, to
        at = to
        give_back()


def text_udf(work: Callable[[pa.Array], list[dict] | pa.Array], result: str, kind: pa.DataType) -> Callable[[Column], Column]:
    """A function of a text column that works on slices of bounded size.

    ``work`` returns one value for each text. Only the text goes to Python.
    """

    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for at, to in slices(texts):
            part = work(texts.slice(at, to - at))
            parts.append(part if isinstance(part, pa.Array) else pa.array(part, type=kind))
        return pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    return F.arrow_udf(run, result)


def list_of(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of the given sizes over consecutive values."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
