"""Ranked lexical search over bit-sliced Bloom signatures, exact by rescoring.

Index. Slices of the documents are cut into shards of documents with a like number of terms. A shard keeps
a bit matrix: a column for each document, a row (a slice) for each of ``width`` signature bits. A term that
occurs tf times sets ``HASHES`` bits for each level j with tf > 2**(j-1), so a document's column tells for
every term and level "surely not" or "perhaps". Beside the matrix lie the documents' ids, lengths, and
sorted terms with their counts. The index is written once and can be searched any number of times.

Search. A term's weight times the largest share that tf <= 2**j allows at the document's own length bounds
what the term adds where level j, and not j + 1, is perhaps reached. The AND of a term's slices gives these
documents for a whole shard at once, and the weighted sum over terms and levels is an upper bound for every
document. Documents are rescored from their terms in falling order of bounds, until the bound is below the
k-th best exact score that the task has seen for the query; nobody else can be among the best k.
Statistics (documents, words, document frequencies) cover the whole index.

Queries come in blocks of at most ``BLOCK_TERMS`` terms (or one query); one block at a time is
packed by a task, passes through the driver and is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.words import ALNUM_LOWER, give_back, mix, slices, small_batches, split_words
from rowloom.session import materialize, scratch_path

HASHES = 3
BITS_PER_KEY = 8  # of a signature, for each key of the shard's average document
LEAST_WIDTH, MOST_WIDTH = 64, 1 << 16
# a shard is full with so many documents or terms, a block of queries with so many terms or queries
SHARD_DOCS, SHARD_TERMS = 2048, 1 << 20
BLOCK_TERMS, BLOCK_QUERIES = 1 << 16, 1024
CHUNK_CELLS = 1 << 21  # terms x documents that are bounded at once
FIRST_RESCORED = 32
SLACK = 1e-9
INDEX = "ids array<bigint>, lengths array<bigint>, width int, slices binary, starts array<bigint>, terms binary, counts binary"
_INDEX_KIND = pa.schema([
    ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("width", pa.int32()), ("slices", pa.binary()), ("starts", pa.list_(pa.int64())),
    ("terms", pa.binary()), ("counts", pa.binary()),
])
BEST = "query_id bigint, doc_id bigint, score bigint"
_NO_ID = np.iinfo(np.int64).max


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, term and count, sorted by text and term, and the number of words of each text."""
    words = split_words(texts, ALNUM_LOWER)
    order = np.lexsort((words.hash, words.text))
    text, term = words.text[order], words.hash[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(fresh)
    return text[at], term[at], np.diff(np.append(at, len(text))), np.bincount(words.text, minlength=len(texts))


def places(terms: np.ndarray, level: int, width: int) -> np.ndarray:
    """The signature bits of every term at a level: one row a term, ``HASHES`` columns."""
    seeds = np.arange(level * HASHES + 1, (level + 1) * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mix(terms[:, None] ^ mix(seeds)[None, :]) & np.uint64(width - 1)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    """The level j of a count: 2**(j-1) < count <= 2**j."""
    return np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64)


def _shard(ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> dict:
    n = len(ids)
    doc, level = np.repeat(np.arange(n), np.diff(starts)), level_of(counts)
    keys = int((level + 1).sum())
    width = 1 << min(max(math.ceil(math.log2(BITS_PER_KEY * keys / n)), LEAST_WIDTH.bit_length() - 1), MOST_WIDTH.bit_length() - 1)
    matrix = np.zeros((width, n), bool)
    for j in range(int(level.max(initial=-1)) + 1):
        hit = level >= j
        matrix[places(terms[hit], j, width).ravel(), np.repeat(doc[hit], HASHES)] = True
    return {
        "ids": [None if x == _NO_ID else x for x in ids.tolist()], "lengths": lengths.tolist(), "width": width, "slices": np.packbits(matrix, axis=1).tobytes(),
        "starts": starts.tolist(), "terms": terms.tobytes(), "counts": counts.astype(np.uint32).tobytes(),
    }


class _Held:
    """Documents of one kind that wait for their shard to fill."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs = self.terms = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray, size: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((ids, lengths, size, terms, counts))
        self.docs, self.terms = self.docs + len(ids), self.terms + len(terms)

    def shard(self) -> pa.RecordBatch:
        ids, lengths, size, terms, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.__init__()
        return pa.RecordBatch.from_pylist([_shard(ids, lengths, np.append(0, np.cumsum(size)), terms, counts)], schema=_INDEX_KIND)


def _index(batches):
    held: dict[int, _Held] = {}
    for batch in batches:
        for a, b in slices(batch.column(1)):
            text, term, count, lengths = bags(batch.column(1).slice(a, b - a))
            ids = batch.column(0).slice(a, b - a).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            size = np.bincount(text, minlength=b - a)
            # documents of one power of four share a shard; those without a term are nowhere
            kind = np.where(size > 0, (np.log2(np.maximum(size, 1)) / 2).astype(np.int64), -1)
            for k in np.unique(kind[kind >= 0]).tolist():
                docs, inside = np.flatnonzero(kind == k), np.repeat(kind == k, size)
                waiting = held.setdefault(k, _Held())
                waiting.add(ids[docs], lengths[docs], size[docs], term[inside], count[inside])
                if waiting.docs >= SHARD_DOCS or waiting.terms >= SHARD_TERMS:
                    yield waiting.shard()
    for waiting in held.values():
        if waiting.docs:
            yield waiting.shard()


def build_index(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the index of all documents with a term as Parquet to ``path``.

    Terms are runs of ASCII letters, digits and all beyond ASCII, A-Z lower-cased; null texts have none. Rows
    with equal ids stay documents of their own; null ids are kept and rank behind all others that score alike.
    """
    small_batches(docs.sparkSession)
    docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).mapInArrow(_index, INDEX).write.parquet(path)


def _query_terms(batches):
    for batch in batches:
        for a, b in slices(batch.column(1)):
            text, term, n, _ = bags(batch.column(1).slice(a, b - a))
            yield pa.record_batch({"q": batch.column(0).slice(a, b - a).take(pa.array(text, pa.int32())), "term": term.view(np.int64), "n": n})


def _blocks(batches):
    """Whole queries, sorted by id, in blocks of at most ``BLOCK_TERMS`` terms or one query: one row each."""
    held: list[tuple[int | None, np.ndarray, np.ndarray]] = []

    def packed():
        size = np.array([len(t) for _, t, _ in held], np.int64)
        return pa.record_batch({
            "ids": pa.array([[q for q, _, _ in held]], pa.list_(pa.int64())), "starts": pa.array([np.append(0, np.cumsum(size)).tolist()], pa.list_(pa.int64())),
            "terms": pa.array([np.concatenate([t for _, t, _ in held]).tobytes()]), "counts": pa.array([np.concatenate([n for _, _, n in held]).tobytes()]),
        })

    for batch in batches:
        for row in batch.to_pylist():
            if held and (len(held) == BLOCK_QUERIES or sum(len(t) for _, t, _ in held) + len(row["terms"]) > BLOCK_TERMS):
                yield packed()
                held.clear()
            order = np.argsort(terms := np.array(row["terms"], np.int64).view(np.uint64))
            held.append((row["q"], terms[order], np.array(row["counts"], np.int64)[order]))
    if held:
        yield packed()


def query_blocks(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """Queries as blocks; rows with the same id, also null, are one query of all their words."""
    terms = queries.select(F.col(f"`{query_id}`").cast("bigint").alias("q"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    terms = terms.mapInArrow(_query_terms, "q bigint, term bigint, n bigint").groupBy("q", "term").agg(F.sum("n").alias("n"))
    rows = terms.groupBy("q").agg(F.collect_list(F.struct("term", "n")).alias("x"))  # a query's distinct terms
    rows = materialize(rows.select("q", F.col("x.term").alias("terms"), F.col("x.n").alias("counts")), "queries")
    terms, ids = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(terms // BLOCK_TERMS, ids // BLOCK_QUERIES) + 1
    return rows.coalesce(blocks).mapInArrow(_blocks, "ids array<bigint>, starts array<bigint>, terms binary, counts binary")


def _frequencies(shared):
    def run(batches):
        wanted = shared.value
        found = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms in batch.column(0):
                terms = np.frombuffer(terms.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
                found += np.bincount(at[wanted[at] == terms], minlength=len(wanted))
            give_back()
        at = np.flatnonzero(found)
        yield pa.record_batch({"at": at, "df": found[at]})

    return run


def weights(frequency: np.ndarray, n: int) -> np.ndarray:
    """floor(1000 ln((2N+2)/(2df+1))) of every document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Shard:
    """A row of the index at work: bounds for all its documents, exact scores for some."""

    def __init__(self, row: dict, n: int, total: int) -> None:
        self.ids = np.array([_NO_ID if x is None else x for x in row["ids"]], np.int64)
        self.width, self.starts = row["width"], np.array(row["starts"], np.int64)
        self.slices = np.frombuffer(row["slices"], np.uint8).reshape(self.width, -1)
        self.terms, self.counts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.m = 25 + 75 * np.array(row["lengths"], np.int64) * n // max(total, 1)
        self.levels = int(level_of(self.counts).max(initial=0)) + 1
        self.most = np.stack([share(np.full(len(self.m), 1 << j, np.int64), self.m) for j in range(self.levels)])

    def bounds(self, terms: np.ndarray, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What each document scores at most: a row for every query, given as places in ``terms`` and weights.

        Shares are below 2**20. Sums beyond 2**53 lose digits, which ``SLACK`` makes up for.
        """
        bound = np.zeros((len(queries), len(self.ids)))
        step = max(CHUNK_CELLS // len(self.ids), 1)
        for a in range(0, len(terms), step):
            most = self._most(terms[a : a + step])
            for i, (at, weight) in enumerate(queries):
                low, high = np.searchsorted(at, (a, a + step))
                if low < high:
                    bound[i] += weight[low:high].astype(float) @ most[at[low:high] - a]
        return bound * (1 + SLACK)

    def _most(self, terms: np.ndarray) -> np.ndarray:
        """The largest share of every term in every document."""
        most = np.zeros((len(terms), len(self.ids)))
        rows = np.arange(len(terms))
        reached = np.full((len(terms), self.slices.shape[1]), 255, np.uint8)
        for j in range(self.levels):
            reached &= np.bitwise_and.reduce(self.slices[places(terms[rows], j, self.width)], axis=1)
            some = reached.any(axis=1)
            rows, reached = rows[some], reached[some]
            if not len(rows):
                break
            most[rows] += np.unpackbits(reached, axis=1, count=len(self.ids)) * (self.most[j] - (self.most[j - 1] if j else 0)).astype(float)
        return most

    def scores(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of the given documents; ``terms`` are sorted."""
        size = self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(self.starts[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        place = np.minimum(np.searchsorted(terms, self.terms[at]), len(terms) - 1)
        hit = terms[place] == self.terms[at]
        doc = np.repeat(np.arange(len(docs)), size)[hit]
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, doc, weight[place[hit]] * share(self.counts[at[hit]], self.m[docs[doc]]))
        return score


class Best:
    """The k best documents seen so far, by falling score and rising id."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """Nothing below this score can enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least
        ids, scores = np.concatenate([self.ids, ids[good]]), np.concatenate([self.scores, scores[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def look_through(shard: Shard, best: Best, bound: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> int:
    """Rescore whatever may be among the best; the number of documents that were rescored."""
    left = np.flatnonzero(bound >= best.least)
    left = left[np.argsort(-bound[left], kind="stable")]
    done, step = 0, FIRST_RESCORED
    while done < len(left) and bound[left[done]] >= best.least:
        some = left[done : done + step]
        some = some[bound[some] >= best.least]
        best.add(shard.ids[some], shard.scores(some, terms, weight))
        done, step = done + step, 2 * step
    return min(done, len(left))


def _search(shared, k: int):
    def run(batches):
        ids, queries, terms, n, total = shared.value
        best = [Best(k) for _ in ids]
        for batch in batches:
            for i in range(len(batch)):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], n, total)
                for found, bound, (at, weight) in zip(best, shard.bounds(terms, queries), queries, strict=True):
                    if len(at):
                        look_through(shard, found, bound, terms[at], weight)
            give_back()
        doc = np.concatenate([b.ids for b in best])
        yield pa.record_batch({
            "query_id": pa.array([q for q, b in zip(ids, best, strict=True) for _ in b.ids], pa.int64()), "doc_id": pa.array(doc, mask=doc == _NO_ID),
            "score": pa.array(np.concatenate([b.scores for b in best])),
        })

    return run


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """``query_id``, ``rank``, ``doc_id``, ``score`` of the k best documents of every query, scores above 0 only.

    A query word counts as often as it occurs; queries without a word, or an empty index, give no row.
    """
    index = spark.read.schema(INDEX).parquet(path)
    sums = index.select(F.size("ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("w"))
    n, total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    parts = []
    for block in query_blocks(queries, query_id, text).toLocalIterator():
        used = np.frombuffer(block.terms, np.uint64)
        terms, at = np.unique(used, return_inverse=True)
        wanted = spark.sparkContext.broadcast(terms)
        counted = index.select("terms").mapInArrow(_frequencies(wanted), "at bigint, df bigint").groupBy("at").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(len(terms), np.int64)
        df[counted["at"].to_numpy()] = counted["df"].to_numpy()
        weight = np.where(df > 0, weights(df, n), 0)  # a term that no document holds adds nothing
        times = np.frombuffer(block.counts, np.int64)
        spans = [np.arange(a, b) for a, b in zip(block.starts, block.starts[1:], strict=False)]
        asked = [(at[x[w > 0]], w[w > 0]) for x in spans for w in [weight[at[x]] * times[x]]]
        shared = spark.sparkContext.broadcast((block.ids, asked, terms, n, total))
        part = scratch_path(spark, "best")
        index.mapInArrow(_search(shared, k), BEST).write.parquet(part)
        parts.append(part)
        for sent in (wanted, shared):
            sent.unpersist()
    found = spark.read.schema(BEST).parquet(*parts) if parts else spark.createDataFrame([], BEST)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """Index all documents in the shared folder and search them once; see ``build_index`` and ``search_index``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "signatures")
    build_index(docs, path, doc_id, text)
    return search_index(spark, path, queries, k, query_id, query_text)
