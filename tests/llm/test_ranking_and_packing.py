"""Hard negatives, signature search and packing against brute force; odd rows in every one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rowloom.llm import gnat, packing, signatures
from rowloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "A b  c. D", "x"), (2, None, None), (2, "", "x"), (None, "the end of the", "y"), (3, "b b b", "y"), (3, "b b b", "y"), (4, "zz " * 9000 + "! B", None), (None, None, None)]
SCHEMA = "doc_id bigint, text string, `my col` string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"row": F.lit(1), "ids": F.lit("i"), "start": F.lit(2), "score": F.lit(0)}).cache()


# ---- packing


def _cheapest_by_all_pairs(places, cost, window):
    best = [0.0] + [math.inf] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= window:
                best[j] = min(best[j], best[i] + (0 if n & (n - 1) == 0 else window - n) + cost[j])
    return best[-1]


def test_plans_are_cheapest():
    rng = np.random.default_rng(7)
    for window in (2, 5, 16, 64):
        for _ in range(60):
            steps = rng.integers(1, window + 1, rng.integers(1, 60))
            places = np.append(0, np.cumsum(steps))
            cost = rng.integers(0, 9, len(places))
            cuts, price = packing.cheapest(places, cost, window)
            assert price == _cheapest_by_all_pairs(places.tolist(), cost.tolist(), window)
            sizes = np.diff(cuts)
            assert cuts[0] == 0 and cuts[-1] == places[-1] and sizes.max() <= window
            paid = sum(0 if s & (s - 1) == 0 else window - s for s in sizes.tolist()) + cost[np.searchsorted(places, cuts[1:])].sum()
            assert paid == price
            part, _ = packing.cheapest(places, cost, window, to_end=False)
            assert part[-1] > places[-1] - window or len(places) == 2


def test_ids_are_those_of_the_tokenizers_library():
    encoder = packing.Encoder.at(PATH)
    assert encoder.fast is not None
    draw = random.Random(3)
    signs = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　​ab'sltdré1²½.-_日\U0001f600"
    texts = ["", "foo<|endoftext|> bar <|endoftext|>", "x" * 5000 + " y", "don't 's　 'll", "日本語。" * 400]
    texts += ["".join(draw.choices(signs, k=draw.randint(1, 50))) for _ in range(3000)]
    for text in texts:
        assert encoder.encode(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids
    long = " ".join(f"w{i} é" for i in range(200_000))
    assert len(long) > 2 * packing.CHUNK and encoder.encode(long).tolist() == encoder.slow.encode(long, add_special_tokens=False).ids


def _whole(pieces, window):
    """Pieces put together give every document's tokens and every sequence without gaps."""
    encoder = packing.Encoder.at(PATH)
    docs, sequences = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        docs.setdefault((r.sequence_id >> 33, r.row.doc_id, r.row.text), []).append((r.start, r.doc_tokens, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (_, _, text), parts in docs.items():
        parts.sort(key=lambda p: p[0])
        total = parts[0][1]
        whole = [*encoder.encode(text or "").tolist(), 0]
        assert total == len(whole) and Counter(np.concatenate([p[2] for p in parts]).tolist()) == Counter(whole * (sum(len(p[2]) for p in parts) // total))
        if sum(len(p[2]) for p in parts) == total:
            assert np.concatenate([p[2] for p in parts]).tolist() == whole and [p[0] for p in parts] == [0, *np.cumsum([len(p[2]) for p in parts])[:-1].tolist()]
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()] and sum(n for _, n in parts) <= window
    return sequences


def test_packing_loses_no_token(spark, sf_dir, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack_documents(docs, PATH, keep=["doc_id", "text"], order_by=["doc_id"]).collect()
    _whole(pieces, 1024)
    again = packing.pack_documents(docs, PATH, keep=["doc_id", "text"], order_by=["doc_id"]).collect()
    assert pieces == again
    got = packing.pack_documents(odd, PATH, window=64).collect()
    _whole(got, 64)
    assert sum(r.start == 0 for r in got) == len(ODD) and set(got[0].row.asDict()) == set(odd.columns)
    assert packing.pack_documents(odd.limit(0), PATH).count() == 0


def test_runs_carry_their_rest_over(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(packing, "RUN_TOKENS", 3000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id < 60").collect()
    batch = pa.RecordBatch.from_pylist([{"row": {"doc_id": r.doc_id, "text": r.text}, "text": r.text} for r in docs])
    out = [r for b in packing._pack(PATH, 1024, 2, 8)([batch]) for r in b.to_pylist()]
    encoder = packing.Encoder.at(PATH)
    assert sum(r["length"] for r in out) == sum(len(encoder.encode(r.text)) + 1 for r in docs)
    got = {}
    for r in sorted(out, key=lambda r: r["start"]):
        got.setdefault(r["row"]["doc_id"], []).append(np.frombuffer(r["ids"], "<u4"))
    assert all(np.concatenate(got[r.doc_id]).tolist() == [*encoder.encode(r.text).tolist(), 0] for r in docs)


def test_padding_is_little_and_sequences_are_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack_documents(docs, PATH, keep=["doc_id"]).cache()
    rows = packing.sequences(pieces).collect()
    assert all(len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 1024) and not any(r.ids[r.n_tokens :]) for r in rows)
    padding, tokens = sum(len(r.ids) - r.n_tokens for r in rows), sum(r.n_tokens for r in rows)
    assert padding < 0.01 * tokens and tokens == pieces.agg(F.sum("length")).first()[0]
    assert Counter(x for r in rows for x in r.ids[: r.n_tokens]) == Counter(x for r in pieces.select("ids").collect() for x in np.frombuffer(r.ids, "<u4").tolist())


# ---- signature search


def _ranked_plainly(docs, items, k):
    words = {i: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, (_, t) in enumerate(docs)}
    words = {i: w for i, w in words.items() if w}
    n, total = len(words), sum(map(len, words.values()))
    df = Counter(t for w in words.values() for t in set(w))
    out = []
    for item, text in items:
        asked = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        scores = []
        for i, w in words.items():
            tf, m = Counter(w), 25 + 75 * len(w) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked if tf[t])
            if score:
                scores.append((-score, docs[i][0] is None, docs[i][0]))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def test_signature_search_is_exact(spark, odd, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 120)) % 400) for _ in range(500)]
    docs = [*enumerate(texts + texts[:40]), (None, "w1 w1"), (None, "w1 w1"), (9000, None), (9001, ""), (9002, "W1 w2 " * 4000)]
    items = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.2, 12) % 400)) for i in range(25)] + [(90, None), (91, "nowhere"), (92, "w1 w1 w1 w2"), (None, "w3")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = signatures.ranked(frame, asked, k=7).collect()
    assert Counter(tuple(r) for r in got) == _ranked_plainly(docs, items, 7)
    monkeypatch.setattr(signatures, "BLOCK_TERMS", 30)  # blocks of one or two queries
    assert signatures.query_blocks(asked, "item_id", "text").count() == 1
    assert signatures.ranked(odd, asked, k=3).count() == 0
    named = odd.withColumnRenamed("doc_id", "item_id")
    assert Counter(tuple(r) for r in signatures.ranked(odd, named.filter("item_id = 3"), k=9).collect()) == _ranked_plainly([r[:2] for r in ODD], [(3, "b b b b b b")], 9)
    assert signatures.ranked(odd.limit(0), asked).count() == 0 and signatures.ranked(odd, asked.limit(0)).count() == 0


def test_queries_are_split_into_blocks(monkeypatch):
    monkeypatch.setattr(signatures, "BLOCK_TERMS", 30)
    rows = [{"q": i, "terms": list(range(i, i + 13)), "counts": [1] * 13} for i in range(7)]
    blocks = list(signatures._blocks([pa.RecordBatch.from_pylist(rows)]))
    assert [b.to_pylist()[0]["ids"] for b in blocks] == [[0, 1], [2, 3], [4, 5], [6]]
    assert list(signatures._blocks([])) == []


def test_bounds_are_never_too_low_and_rule_out_most():
    rng = np.random.default_rng(9)
    texts = pa.array([" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 300)) % 3000) for _ in range(3000)])
    shards = [s for b in signatures._index([pa.record_batch({"id": np.arange(3000), "text": texts})]) for s in b.to_pylist()]
    n, total = sum(len(s["ids"]) for s in shards), sum(sum(s["lengths"]) for s in shards)
    terms = np.unique(np.concatenate([np.frombuffer(s["terms"], np.uint64) for s in shards]))
    df = np.bincount(np.concatenate([np.searchsorted(terms, np.frombuffer(s["terms"], np.uint64)) for s in shards]))
    weight = signatures.weights(df, n)
    rescored = 0
    for _ in range(20):
        at = np.sort(rng.choice(len(terms), 8, replace=False))
        best = signatures.Best(10)
        for s in shards:
            shard = signatures.Shard(s, n, total)
            bound = shard.bounds(terms, [(at, weight[at])])[0]
            assert (bound >= shard.scores(np.arange(len(shard.ids)), terms[at], weight[at])).all()
            rescored += signatures.look_through(shard, best, bound, terms[at], weight[at])
    assert rescored < 0.2 * 20 * n


# ---- hard negatives


def _mined_plainly(rows):
    good = [(i, l, [math.floor(256 * float(x)) for x in v] + [0] * (4 - len(v))) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, v in good:
        if i is None or i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j, lab) for j, lab, w in good if j != i)
        for s, _, j, _ in [x for x in scored if x[3] == label][:5]:
            fits = [x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, rank, x[2], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return Counter(out)


def test_hard_negatives_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(0, 1, 4)]) for i in range(400)]
    rows += [(1000 + i, i % 2, [0.5, 0.5, 0.25, 0.0]) for i in range(200)]  # a third alike
    rows += [(2000, None, [1.0] * 4), (2010, 1, None), (2020, 1, [1.0, None, 0.0, 0.0]), (2030, 1, [float("nan")] * 4), (2040, 1, [float("inf")] * 4), (2050, 1, []), (2060, 2, [1.0, 1.0]), (2070, 2, [0.0] * 4)]
    rows += [(None, 1, [0.4] * 4), (20, 1, [0.9] * 4), (20, 1, [0.9] * 4)]
    schema = "vec_id bigint, label int, embedding array<float>"
    rows = [(i, l, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows]
    frame = spark.createDataFrame(rows, schema).repartition(3).withColumns({"slot": F.lit(1), "my col": F.lit("a")})
    assert Counter(tuple(r) for r in gnat.mine(frame, "vec_id % 10 = 0").collect()) == _mined_plainly(rows)
    monkeypatch.setattr(gnat, "BLOCK", 7)  # of the driver: several blocks
    assert Counter(tuple(r) for r in gnat.mine(frame, "vec_id % 10 = 0").collect()) == _mined_plainly(rows)
    assert gnat.mine(frame.limit(0), "vec_id % 10 = 0").count() == 0 and gnat.mine(frame, "vec_id < 0").count() == 0


def test_anchors_come_in_blocks(monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 4)
    batch = pa.record_batch({"id": pa.array([*range(8), None]), "label": pa.array([1] * 9), "vector": pa.array([[i] for i in range(9)], pa.list_(pa.int64()))})
    assert [b.to_pylist()[0]["ids"] for b in gnat._blocks(1)([batch])] == [[0, 1, 2, 3], [4, 5, 6, 7], [None]]


def test_tree_passes_over_far_leaves():
    """Elimination loses nothing that scores inside a window, and leaves out most rows of clustered vectors."""
    rng = np.random.default_rng(12)
    centre = rng.normal(0, 300, (60, 16))
    x = np.round(centre[rng.integers(0, 60, 6000)] + rng.normal(0, 15, (6000, 16))).astype(np.int64)
    tree = gnat.Tree(x[:2000], gnat.FANOUT, gnat.LEAF_SAMPLE)
    leaf, distance = tree.route(x)
    order = np.lexsort((distance, leaf))
    x, leaf, distance = x[order], leaf[order], distance[order]
    ranges = gnat.Ranges(tree)
    shared = type("Sent", (), {"value": tree})
    measured = gnat._measured(shared, 16)([pa.record_batch({"leaf": leaf.astype(np.int32), "vector": pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary())})])
    ranges.take(pa.Table.from_batches(measured))
    ids, labels = np.arange(len(x)), rng.integers(0, 2, len(x))
    chosen = rng.choice(len(x), 50, replace=False)
    wanted = gnat.Wanted(ids[chosen], labels[chosen], x[chosen], 1, 10, same=False)
    own = (x[chosen] ** 2).sum(axis=1)
    wanted.low[:, 0], wanted.high[:, 0] = own * 6 // 10, own * 9 // 10
    search = gnat.Search(wanted, tree, ranges)
    for n in np.unique(leaf):
        at = leaf == n
        search.leaf(int(n), ids[at], labels[at], x[at], distance[at])
    got = search.hits().to_pylist()
    for a, c in enumerate(chosen):
        score = x @ x[c]
        fits = np.flatnonzero((labels != labels[c]) & (score >= wanted.low[a, 0]) & (score <= wanted.high[a, 0]))
        best = sorted(zip((-score[fits]).tolist(), ids[fits].tolist(), strict=True))[:10]
        assert sorted((-h["score"], h["other"]) for h in got if h["anchor"] == a) == best
    assert search.scored < 0.5 * 50 * len(x)


def test_queries_carry_their_columns(spark, sf_dir):
    assert QUERIES["op11_hard_negatives"](spark, sf_dir).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert QUERIES["op12_signature_search"](spark, sf_dir).columns == ["item_id", "rank", "doc_id", "score"]
    assert QUERIES["op13_pack_documents"](spark, sf_dir).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
