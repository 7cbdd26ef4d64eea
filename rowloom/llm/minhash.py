"""Near-duplicate detection by SuperMinHash, banding, verification and union-find.

A text's set holds the hashes of its word shingles. SuperMinHash gives each element a random
permutation of the signature's slots and writes its j-th rank, j plus a random fraction, to the j-th
slot of the permutation; slots keep their minimum. Ranks of one element are correlated, which makes
the estimate less variable than independent hashes do, and an element stops as soon as its rank is
above every slot of the text.

Texts with equal sets are one class. Classes are linked within buckets of equal bands: see
``near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.graph import components
from rowloom.llm.sieve import bit_table, perhaps
from rowloom.llm.words import SPACED_LOWER, joined, list_of, mix, slices, small_batches, split_words
from rowloom.operators.keys import apart
from rowloom.session import materialize

ROWS, BANDS = 6, 40
_GROUP = 1 << 16  # set elements that are ranked at once
_FULL = np.uint32(0xFFFFFFFF)
DIGEST = "struct<n:bigint,a:bigint,b:bigint,bands:array<bigint>>"
_DIGEST = pa.struct([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("bands", pa.list_(pa.int64()))])


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every distinct shingle, sorted; a text of fewer words is one shingle."""
    words = split_words(texts, SPACED_LOWER)
    first = words.first
    n = np.diff(first)
    runs = joined(words.hash, size)
    whole = words.text[: len(runs)] == words.text[size - 1 :] if len(runs) else np.zeros(0, bool)
    text, value = [words.text[: len(runs)][whole]], [runs[whole]]
    for length in range(1, size):
        short = np.flatnonzero(n == length)
        if len(short):
            text.append(short.astype(np.int32))
            value.append(joined(words.hash, length)[first[short]])
    text, value = np.concatenate(text), np.concatenate(value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[fresh], value[fresh]


def superminhash(text: np.ndarray, value: np.ndarray, n_texts: int, slots: int) -> np.ndarray:
    """Signatures of the sets given as (text number, element); slots of empty sets stay full."""
    sizes = np.bincount(text, minlength=n_texts)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    signature = np.full((n_texts, slots), _FULL, np.uint32)
    order = np.argsort(-sizes, kind="stable")
    order = order[: int((sizes > 0).sum())]
    at = 0
    total = np.cumsum(sizes[order])
    while at < len(order):  # texts of like size together: they stop at about the same rank
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + _GROUP, side="right")))
        group = order[at:to]
        elements = np.concatenate([value[starts[t] : starts[t + 1]] for t in group])
        signature[group] = _rank(np.repeat(np.arange(len(group)), sizes[group]), elements, len(group), slots)
        at = to
    return signature


def _rank(owner: np.ndarray, element: np.ndarray, n: int, slots: int) -> np.ndarray:
    out = np.full((n, slots), _FULL, np.uint32)
    flat = out.reshape(-1)
    perm = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(element), slots)).copy()
    row = np.arange(len(element))
    for j in range(slots):
        u = mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        swap = (j + (u >> np.uint64(32)) % np.uint64(slots - j)).astype(np.int64)
        slot = perm[row, swap]
        perm[row, swap] = perm[row, j]
        rank = (u & np.uint64(0xFFFFFF)).astype(np.uint32) | np.uint32(j << 24)
        np.minimum.at(flat, owner * slots + slot, rank)
        live = (out.max(axis=1) >> np.uint32(24)) > j
        keep = live[owner]
        if not keep.any():
            break
        if not keep.all():
            owner, element, row = owner[keep], element[keep], row[keep]
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), -1, rows).astype(np.uint64)
    value = np.zeros(parts.shape[:2], np.uint64)
    for i in range(rows):
        value = mix(value * np.uint64(31) + parts[:, :, i] + np.uint64(1))
    return mix(value + np.arange(parts.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _digest(size: int, rows: int, n_bands: int):
    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for at, to in slices(texts):
            text, value = shingle_sets(texts.slice(at, to - at), size)
            count = np.bincount(text, minlength=to - at)
            found = bands(superminhash(text, value, to - at, rows * n_bands), rows)
            sums = []
            for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(value ^ np.uint64(salt)), dtype=np.uint64)])
                ends = np.concatenate([[0], np.cumsum(count)])
                sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
            listed = list_of(found[count > 0].reshape(-1).view(np.int64), np.where(count > 0, n_bands, 0), pa.int64())
            parts.append(pa.StructArray.from_arrays([pa.array(count.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), listed], fields=list(_DIGEST)))
        return pa.concat_arrays(parts) if parts else pa.array([], type=_DIGEST)

    return run


COMPARED = "struct<linked:boolean,common:bigint,left_0:bigint,left_1:bigint,right_0:bigint,right_1:bigint>"
_COMPARED = pa.struct([("linked", pa.bool_()), *[(x, pa.int64()) for x in ("common", "left_0", "left_1", "right_0", "right_1")]])


def _compare(size: int, share: int):
    """Whether two texts are linked, their common shingles, and 128-bit marks of those that only one has."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for at, to in slices(left, 1 << 20):
            (ta, va), (tb, vb) = (shingle_sets(x.slice(at, to - at), size) for x in (left, right))
            a, b = (np.bincount(t, minlength=to - at) for t in (ta, tb))
            text, value = np.concatenate([ta, tb]), np.concatenate([va, vb])
            side = np.repeat([0, 1], [len(ta), len(tb)])
            order = np.lexsort((value, text))
            text, value, side = text[order], value[order], side[order]
            pair = (text[1:] == text[:-1]) & (value[1:] == value[:-1])
            alone = ~(np.concatenate([pair, [False]]) | np.concatenate([[False], pair])) if len(text) else np.zeros(0, bool)
            both = np.bincount(text[1:][pair], minlength=to - at)
            marks = np.zeros((4, to - at), np.uint64)
            bit = np.uint64(1) << (value & np.uint64(63))
            np.bitwise_or.at(marks, (2 * side[alone] + (value[alone] >> np.uint64(6) & np.uint64(1)).astype(np.int64), text[alone]), bit[alone])
            fields = [pa.array(100 * both >= share * (a + b - both)), pa.array(both.astype(np.int64)), *[pa.array(m.view(np.int64)) for m in marks]]
            out.append(pa.StructArray.from_arrays(fields, fields=list(_COMPARED)))
        return pa.concat_arrays(out) if out else pa.array([], type=_COMPARED)

    return run


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, share: int = 80, rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n`` (shingles), ``component_id`` and ``first`` for every document.

    Two texts are linked when 100 * common >= share * all distinct shingles. ``component_id`` is the least
    id reachable over links; ``first`` marks one row of each group, the first with that id. Texts without
    words have no set and are linked with nothing. Null ids sort after all others: a group of null ids only
    has a null component. Rows with equal ids are separate documents.

    1. Texts with equal sets are one class, so exact copies are grouped before anything else.
    2. Bucket sizes are counted; a class is the more central, the larger its buckets. In every bucket
       all others are compared with its most central member: one pair per member.
    3. Components of the confirmed pairs are found. Where a bucket still holds several components, any link
       across them would join them, so members outside the central one's component are held against all
       others. What is known from the comparison with the central member bounds how much two members can
       share: what both keep of it, at most what neither lacks, and what both add to it. 128-bit marks of
       the shingles lacked and added make the bounds close. Only pairs whose bounds allow a link are made.
    Pairs are confirmed on whole sets.
    """
    spark = docs.sparkSession
    small_batches(spark)
    digest = F.arrow_udf(_digest(size, rows, n_bands), DIGEST)(F.col(f"`{text}`"))
    seen = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), digest.alias("d"))
    seen = materialize(seen.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text_hash", "d.*"), "digests")
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    classes = seen.filter("n > 0").groupBy("a", "b", "n", "bands").agg(F.min(lead).alias("lead"), F.min(F.struct("text_hash", "doc_id")).alias("sample"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "classes")
    member = classes.select("node", "n", F.explode("bands").alias("bucket"))
    crowds = materialize(member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    member = materialize(member.join(crowds, "bucket"), "members")
    central = member.groupBy("node").agg(F.sum("size").alias("centre"))
    member = materialize(member.join(central, "node").select("bucket", "node", "n", "centre"), "centred")
    pivot = member.groupBy("bucket").agg(F.max(F.struct("centre", -F.col("node"), "n")).alias("p"))
    pivot = pivot.select(apart("bucket").alias("key"), (-F.col("p.col2")).alias("pivot"), F.col("p.n").alias("n_pivot"))
    member = materialize(member.join(pivot, member["bucket"] == pivot["key"]).select("bucket", "node", "n", "pivot", "n_pivot"), "starred")
    wanted = classes.join(member.select("node").distinct(), "node").select("node", "sample.*")
    texts = _texts(docs, text, doc_id, wanted)
    stars = member.filter("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = materialize(_compared(stars, texts, size, share), "stars")
    links = stars.filter("linked").select("a", "b")
    groups = components(links)
    placed = member.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    main = groups.select(F.col("node").alias("main_node"), F.col("root").alias("main"))
    placed = placed.join(main, placed["pivot"] == main["main_node"], "left").withColumn("main", F.coalesce("main", "pivot")).filter("node != pivot")
    known = stars.select(F.col("a").alias("known_a"), F.col("b").alias("known_b"), "common", *[f"{s}_{i}" for s in ("left", "right") for i in (0, 1)])
    placed = placed.join(known, (F.col("node") == F.col("known_a")) & (F.col("pivot") == F.col("known_b")))
    columns = ["node", "n", "n_pivot", "root", "main", "common", "left_0", "left_1", "right_0", "right_1"]
    placed = materialize(placed.select("bucket", *columns), "placed")
    outside, others = (placed.select("bucket", *[F.col(c).alias(f"{x}_{c}") for c in columns]) for x in "xy")
    outside = outside.filter("x_root != x_main")
    across = outside.join(others, "bucket").filter((F.col("x_root") != F.col("y_root")) & ((F.col("x_node") < F.col("y_node")) | (F.col("y_root") == F.col("y_main"))) & _may_link(share))
    across = across.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    across = _compared(across, texts, size, share).filter("linked").select("a", "b")
    groups = components(links.union(across))
    grouped = classes.select("node", "a", "b", "n", "lead").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = grouped.groupBy("root").agg(F.min("lead").alias("best"))
    labels = grouped.join(best.select(apart("root").alias("r"), "best"), F.col("root") == F.col("r"))
    labels = materialize(labels.select("a", "b", "n", "best"), "labels")
    out = seen.join(labels, ["a", "b", "n"], "left")
    first = F.coalesce(F.col("rid") == F.col("best.rid"), F.lit(True))
    component = F.when(F.col("n") > 0, F.col("best.doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n", component.alias("component_id"), first.alias("first"))


def _texts(docs: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` of one member of each wanted class."""
    hashed = docs.select(F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").alias("text"))
    hashed = hashed.filter(perhaps(bit_table(wanted, "text_hash"), F.col("h")))
    found = hashed.join(wanted, (F.col("h") == F.col("text_hash")) & F.col("i").eqNullSafe(F.col("doc_id")))
    return materialize(found.groupBy("node").agg(F.max("text").alias("text")), "candidate-texts")


def _compared(pairs: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    left, right = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    result = F.arrow_udf(_compare(size, share), COMPARED)("text_a", "text_b")
    return pairs.join(left, "a").join(right, "b").select("a", "b", result.alias("r")).select("a", "b", "r.*")


def _may_link(share: int):
    """Whether x and y, each compared with the same central text, can be linked."""

    def only(side: str, a: str, b: str):
        """At least so many marked shingles has a that b has not."""
        return sum(F.bit_count(F.col(f"{a}_{side}_{i}").bitwiseAND(F.bitwise_not(F.col(f"{b}_{side}_{i}")))) for i in (0, 1))

    def lacked(a: str, b: str):
        return F.col("x_n_pivot") - F.col(f"{a}_common") + only("right", b, a)

    def added(a: str, b: str):
        return F.col(f"{a}_n") - F.col(f"{a}_common") - only("left", a, b)

    most = F.col("x_n_pivot") - F.greatest(lacked("x", "y"), lacked("y", "x")) + F.least(added("x", "y"), added("y", "x"))
    return (100 + share) * most >= share * (F.col("x_n") + F.col("y_n"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group; the columns of ``docs``. Texts without words all stay.

    Only texts that have a removed double go through an exchange. Of rows that are alike in id and
    text, one stays.
    """
    found = materialize(near_duplicates(docs, text, doc_id, **options), "near-duplicates")
    doubles = found.filter(~F.col("first")).select("text_hash").distinct()
    doubles = materialize(doubles, "doubles")
    stay = found.filter("first").join(doubles, "text_hash", "left_semi").select("text_hash", F.col("doc_id").alias("stay"))
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{doc_id}`").alias("i"))
    hashed = hashed.withColumn("double", perhaps(bit_table(doubles, "text_hash"), F.col("h")))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    kept = [hashed.filter(~F.col("double")).select("row")]
    some = hashed.filter("double")
    kept.append(some.join(doubles, F.col("h") == F.col("text_hash"), "left_anti").select("row"))
    chosen = some.join(stay, (F.col("h") == F.col("text_hash")) & F.col("i").eqNullSafe(F.col("stay")))
    kept.append(chosen.groupBy("h", "i").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row"))
    return kept[0].union(kept[1]).union(kept[2]).select(*columns)
