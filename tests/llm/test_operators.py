"""The dealt operators against SQL, plain Python and planted cases; odd rows in every one."""

import re
import zlib
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowloom.llm import decontaminate, hmm, langid, licenses, minhash, mixing, phrases, pii, search, warc
from rowloom.llm.queries import QUERIES, SQL
from rowloom.llm.words import ALNUM_LOWER, SPACED, SPACED_LOWER, joined, split_words

LONG = "the quick brown fox jumps over the lazy dog and runs far away from the old grey wolf near a cold river " * 3
ODD = [
    (1, LONG, "en", "a", 9), (2, LONG, "en", "a", 8), (2, LONG, "en", "a", 8), (3, None, None, None, 7), (None, LONG + " more", "en", "b", 6),
    (4, "", "fr", "b", 5), (5, " \t\n", None, "b", 4), (6, "Mail bob.x@host.example.org or +1 (521) 555-2373 from 10.0.0.255, card 4111 1111 1111 1111", "en", None, 3),
    (7, "wörter über straße " * 500, "de", "c", 2), (None, None, None, None, None),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, rid int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and repeated rows, and a column that is called like a work column."""
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = duck.execute(SQL[name])
    columns = [d[0] for d in found.description]
    theirs = Counter(found.fetchall())
    assert Counter(tuple(r) for r in QUERIES[name](spark, sf_dir).select(columns).collect()) == theirs


def test_words_are_those_of_the_pattern():
    texts = ["Ab\x1cC  d\n", "", None, "é É x" * 9, "\x00 a", "1,2;ab" * 3]
    for rule, pattern in ((SPACED_LOWER, r"[^\x20\x09-\x0D]+"), (ALNUM_LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = split_words(pa.array(texts), rule)
        for i, text in enumerate(texts):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            got = [words.data[a:b].tobytes().decode() for a, b in zip(words.start[words.text == i], words.end[words.text == i], strict=True)]
            assert [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in got] == re.findall(pattern, low)
    assert split_words(pa.array(["x yz x", "X"]), SPACED_LOWER).hash.tolist()[0] == split_words(pa.array(["q X"]), SPACED_LOWER).hash[1]


def test_mixing_meets_targets_and_repeats(spark, odd, none):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 3}" if i % 5 else None, None, 0) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, size int")
    first = {r.row.doc_id: r for r in mixing.mix(docs).collect()}
    again = {r.row.doc_id: r.copies for r in mixing.mix(docs.repartition(7)).collect()}
    assert {k: r.copies for k, r in first.items()} == again
    total = sum(r.size for r in first.values())
    target = {r.source: r.target for r in first.values()}
    assert sum(target.values()) == pytest.approx(total)
    for source, wanted in target.items():
        taken = sum(r.copies * r.size for r in first.values() if r.source == source)
        assert abs(taken - wanted) <= 0.01 * wanted + 20
    assert max(r.copies for r in first.values()) <= 3
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0
    assert mixing.mixed(odd).columns == ["repetition", *odd.columns]


def test_rows_that_are_alike_have_places_apart(spark):
    """A thousand equal rows at twice their size: each twice; at one and a half times: half of them once more."""
    docs = spark.createDataFrame([(1, "one two", "a", None, 0)] * 1000 + [(i, "w " * 2000, "b", None, 0) for i in range(2, 4)], "doc_id bigint, text string, source string, lang string, size int")
    for weights, wanted in (((1.0, 1.0), 3000), ((2.0, 1.0), 4000)):
        got = mixing.mix(docs, weights=weights).filter("source = 'a'").collect()
        target = got[0].target
        assert target == pytest.approx(wanted, rel=0.34) and abs(sum(r.copies * r.size for r in got) - target) <= 0.02 * target
        again = mixing.mix(docs.repartition(5), weights=weights).filter("source = 'a'").collect()
        assert sorted(r.copies for r in got) == sorted(r.copies for r in again)


def test_water_filling_caps_and_shares(spark):
    sources = spark.createDataFrame([("a", 10, 1.0), ("b", 1000, 2.0), ("c", 40, 3.0)], "source string, source_size bigint, weight double")
    got = {r.source: r.target for r in mixing.fill_targets(sources, 3.0).collect()}
    assert got == pytest.approx({"a": 30.0, "c": 120.0, "b": 900.0})


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def _plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
            good = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 13 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15)[kind]
            found += [(kind, *m.span())] if good else []
    return found


def test_base_spans_are_those_of_the_patterns():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        text = "".join(rng.choice(list("a.b@-+ 0123(45)6789é\n"), rng.integers(0, 60)))
        assert pii.base_spans(text) == _plain_spans(text)
    assert pii.base_spans("4111111111111111 a@b.c 256.1.1.1 1.2.3.4.5.6.7.8") == _plain_spans("4111111111111111 a@b.c 256.1.1.1 1.2.3.4.5.6.7.8")


def test_disclosing_terms_go_and_clean_documents_stay(spark, odd, none):
    rows = [(i, f"call zanzibar at a{i % 2}@x.org about common things" if i < 8 else f"common things about call number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("@" not in t and "[EMAIL]" in t for i, t in clean.items() if i < 8)
    assert all(clean[i] == t for i, t in rows if i >= 8)
    assert pii.sanitise(odd).count() == len(ODD) and pii.sanitise(none).count() == 0
    shown = [r.text for r in pii.sanitise(odd).filter("doc_id = 6").collect()][0]
    assert shown == "Mail [EMAIL] or [PHONE] from [IP], card [CARD]"


def test_disclosing_terms_go_wherever_they_stand(spark):
    """Shares counted plainly over whole documents; every occurrence in a document with the entity is a span."""
    draw = np.random.default_rng(6)
    fill = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(draw.choice(fill, 30))
        if i % 10 == 0:  # an entity of 15 documents, with its term far off and twice
            words = ["Zanzibar", *words, "x.y@host.example.org", *draw.choice(fill, 20), "zanzibar", "é"]
        if i in (3, 4):
            words += ["zanzibar"] if i == 3 else ["solo@host.example.org", "unique"]
        rows.append((i, " ".join(words)))
    found = {r.row.doc_id: r for r in pii.find_private(spark.createDataFrame(rows, "doc_id int, text string"), keep=["doc_id"]).collect()}
    bags = {i: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(r"\S+@\S+", " ", t).lower())) for i, t in rows}
    whole = {i: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) for i, t in rows}
    holders = [i for i in bags if i % 10 == 0]
    share = {}
    for t in set().union(*(bags[i] for i in holders)):
        n_et, n_t = sum(t in bags[i] for i in holders), sum(t in w for w in whole.values())
        share[t] = np.log(150 * n_et / len(holders) / n_t) / np.log(150 / len(holders)) if n_et >= pii.SUPPORT else -1
    told = {t for t, v in share.items() if v >= pii.GENERALISE_AT}
    assert told == {"zanzibar", "é"} and share["zanzibar"] < 1
    for i, t in rows:
        spans = [(s.start, s.end) for s in found[i].spans if s.kind == pii.TERM]
        plain = [m.span() for m in re.finditer(r"\S+", t) if m[0].lower() in told] if i in holders else []
        assert spans == plain, i
    assert all(abs(s.share - share[rows[i][1][s.start : s.end].lower()]) < 1e-9 for i in holders for s in found[i].spans if s.kind == pii.TERM)


def test_language_is_learned_and_mixed_text_is_split(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, sf_dir).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert sum(got[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
    model = langid.fit(docs)
    parts = {r.lang: r.text for r in docs.filter("length(text) > 400").orderBy("doc_id").collect()}
    mixed = parts["fr"][:300] + " " + parts["de"][:300]
    label = langid.Labeller(model, langid.SWITCH).label([mixed, None, "12 !", "Привет"], True)
    assert {s["lang"] for s in label[0]["spans"]} >= {"fr", "de"} and label[1]["lang"] == label[2]["lang"] == "und" and label[3]["lang"] in model.languages
    assert langid.fit(none) is None
    assert langid.keep_identified(odd, odd).columns == odd.columns and langid.keep_identified(none, none).count() == 0


def test_language_stage_keeps_what_it_can_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(plain, plain).count() == docs.count()  # nothing is known: nothing goes
    parts = [r.text for r in docs.filter("length(text) > 400").dropDuplicates(["lang"]).orderBy("lang").limit(3).collect()]
    rows = [(-1, " ".join(p[:300] for p in parts)), (-2, None), (-3, "12 34 !"), (-4, "")]
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in langid.keep_identified(docs.select("doc_id", "text").union(more), docs).collect()}
    assert -1 in kept and not kept & {-2, -3, -4}


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.zeros((3, langid.BUCKETS), np.float32), np.ones((3, len(langid.SCRIPTS)), bool), np.zeros(3))
    labeller = langid.Labeller(model, 2.0)
    labeller.scores = rng.normal(0, 2, (40, 3)).astype(np.float32)
    rows = [rng.integers(0, 40, n).astype(np.int32) for n in (0, 1, 5, 9, 9, 2)]
    for row, path in zip(rows, labeller._viterbi(list(rows)), strict=True):
        best = {(): 0.0}
        for w in row:  # all paths
            best = {(*p, s): v + labeller.scores[w, s] - (2.0 if p and p[-1] != s else 0) for p, v in best.items() for s in range(3)}
        assert len(row) == 0 or best[tuple(path)] == pytest.approx(max(best.values()), abs=1e-4)


def test_near_duplicates_handle_odd_rows(odd, none):
    got = minhash.near_duplicates(odd, size=4).collect()
    assert len(got) == len(ODD)
    assert {r.component_id for r in got if r.n and r.doc_id in (1, 2)} == {1}
    kept = minhash.drop_near_duplicates(odd).collect()
    assert sorted(r.doc_id for r in kept if r.text == LONG) == [1] and len(kept) == 7
    assert minhash.drop_near_duplicates(none).count() == 0


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (400, 100, 100))
    text = np.repeat([0, 1], 500)
    signature = minhash.superminhash(text, np.concatenate([common, a, common, b]), 2, 240)
    assert abs((signature[0] == signature[1]).mean() - 400 / 600) < 0.1


def test_archives_come_back_whole(spark, tmp_path):
    rows = [(1, "u", "<p>a</p>" * 50), (2, "v", "<p>a</p>" * 50), (2, "v", "<p>a</p>" * 50), (3, None, None), (None, "w", ""), (4, "x\r\ny", "é" * 1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/a")
    got = warc.read_archives(spark, f"{tmp_path}/a").collect()
    assert Counter((r.id, r.record_type, r.refers_to) for r in got) == Counter([("1", "revisit", "2"), ("2", "response", None), ("2", "response", None), ("3", "response", None), (None, "revisit", "3"), ("4", "response", None)])
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {("<p>a</p>" * 50).encode(), b"", ("é" * 1000).encode()}
    warc.write_archives(pages.limit(0), f"{tmp_path}/b")
    assert warc.read_archives(spark, f"{tmp_path}/b").count() == 0


def test_licences_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, "Released under the MIT License.\nThe and of"), (-2, None), (-3, "the license plate of the red car"), (-3, "")], "doc_id bigint, text string")
    got = {r.row.doc_id: r for r in licenses.find_licenses(docs.union(more)).collect()}
    assert got[-1].families == ["mit"] and got[-2].n_lines == 0 and got[-3].families == []
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(bool(got[i].families) == bool(re.search("Released under the MIT|icensed under", t)) for i, t in texts.items())


def test_wrapped_licences_are_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("length(text) < 3000")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    mit = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the Software), to deal"
    apache = "x = 1\n\n * you may not use this file except in compliance with the License.\n * You may obtain a copy of the License at\n\nx = 2"
    inside = "one two three four " * 60 + bsd.replace("\n", " ") + " five six seven eight" * 60
    apart = "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted provided that the following conditions are met"
    texts = [bsd, mit, apache, inside, apart, "The MIT License"]
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.row.doc_id: r for r in licenses.find_licenses(docs.union(more)).filter("row.doc_id < 0").collect()}
    assert [got[-1 - i].families for i in range(len(texts))] == [["bsd"], ["mit"], ["apache-2.0"], ["bsd"], [], ["mit"]]
    assert [got[-1 - i].n_lines for i in range(3)] == [3, 2, 4]


def test_hidden_markov_scores(spark, sf_dir, odd, none):
    got = QUERIES["op8_hidden_markov"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), None] for i, t in texts.items()}
    count = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in t)
    n, v = sum(count.values()), len(count)
    for r in got:
        assert r.base_score == pytest.approx(sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[r.doc_id]))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[r.doc_id]), sum(count[w] > 0 for w in tokens[r.doc_id]), n)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert hmm.score_texts(odd.withColumn("my col", F.lit(1)), F.lit(True)).filter("row.`my col` = 1").count() == len(ODD)
    assert hmm.score_texts(odd, F.col("doc_id") != 1).count() == len(ODD) and hmm.score_texts(none, F.lit(True)).count() == 0


def test_forward_recursion_sums_all_paths():
    rng = np.random.default_rng(2)
    model = hmm.Model(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(2), rng.random((2, 2)), rng.random((2, 3)))))
    row = np.array([0, 2, 1, 1])
    total = sum(
        np.prod([model.start[p[0]], *[model.move[a, b] for a, b in zip(p, p[1:], strict=False)], *[model.emit[s, w] for s, w in zip(p, row, strict=True)]])
        for p in np.ndindex(2, 2, 2, 2)
    )
    assert hmm.forward(model, [row, row[:1]])[0] == pytest.approx(np.log(total))
    expected = hmm.expect(model, [row, row[:1]])
    assert expected[:2].sum() == pytest.approx(2) and expected[2:6].sum() == pytest.approx(3) and expected[6:12].sum() == pytest.approx(5)


def test_hidden_markov_learns_from_all_texts_in_each_round(spark):
    """More texts than any warm-up once held; the same rounds over all of them at once give the same model."""
    rng = np.random.default_rng(5)
    rows = [np.append(rng.integers(0, 4, rng.integers(0, 9)), 5) for _ in range(3000)]
    words = np.bincount(np.concatenate(rows), minlength=6)
    counts = hmm.Counts(np.arange(4, dtype=np.uint64), words[:4], np.arange(4), len(rows), int(words.sum()), 5, 4, 5, 0, 0)
    table = [(i, True, len(r), bytearray(r.astype("<u2").tobytes())) for i, r in enumerate(rows)]
    encoded = spark.createDataFrame(table, "rid bigint, training boolean, n_tokens bigint, codes binary").repartition(3)
    model, share = hmm.guess(counts, 2)
    for _ in range(2):
        model = hmm._model(hmm.expect(model, rows)[:-1], 2, share * 0.5)
    for mine, theirs in zip(hmm.fit(encoded, counts, 2, 2), model, strict=True):
        assert mine == pytest.approx(theirs)


def test_hidden_markov_deals_long_texts_over_several_files(spark, monkeypatch):
    """A file holds its share of the tokens, not of the texts; texts of a file are of like length."""
    made, real = [], hmm.materialize
    monkeypatch.setattr(hmm, "materialize", lambda df, label="stage": made.append((label, real(df, label))) or made[-1][1])
    monkeypatch.setattr(hmm, "PART_TOKENS", 5000, raising=False)
    texts = ["a b c"] * 400 + [f"w{i} " * 20 for i in range(200)] + ["long " * 1000] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert hmm.score_texts(docs, F.lit(True), rounds=1).count() == len(texts)
    kept = dict(made)["training"].groupBy(F.input_file_name().alias("f")).agg(F.sum(F.length("codes") / 2).alias("n"), F.count("*").alias("k")).collect()
    assert sum(r.k for r in kept) == len(texts) and sum(r.n for r in kept) == sum(len(t.split()) + 1 for t in texts)
    assert len(kept) >= 8 and max(r.n for r in kept) < 15000


def test_places_of_values_that_share_a_slot():
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([rng.integers(0, 1 << 62, 500), 7 + (np.arange(50) << 40)]).astype(np.uint64))
    asked = np.concatenate([rng.permutation(values), np.array([0, 7, 8, 1 << 63, (99 << 40) + 7], np.uint64)])
    place, known = hmm.Finder(values, rng.integers(1, 9, len(values)))(asked)
    assert known.tolist() == np.isin(asked, values).tolist() and (values[place[known]] == asked[known]).all()
    assert not hmm.Finder(values[:0], values[:0])(asked)[1].any()


def test_repeats_handle_odd_rows(odd, none):
    got = phrases.remove_repeats(odd).collect()
    assert len(got) == len(ODD)
    assert [r.n_removed for r in got if r.row.doc_id in (1, 2)] == [0, 66, 66]
    assert phrases.remove_repeats(odd.withColumn("my col", F.lit(1))).filter("row.`my col` = 1").count() == len(ODD)
    assert all(r.n_removed == 0 for r in got if r.row.doc_id is None) and phrases.remove_repeats(none).count() == 0


@pytest.mark.parametrize("most", [3, phrases.CODE_POINTS])
def test_automata_take_any_number_of_words(monkeypatch, most):
    """With few code points words become numbers; a text of more distinct words than there are code points ends."""
    monkeypatch.setattr(phrases, "CODE_POINTS", most)
    shared = " ".join(f"s{i}" for i in range(40))
    long = " ".join(f"w{i}" for i in range(1_200_000)) if most > 3 else "x y z"
    texts = pa.array([f"a {shared} b", f"{long} {shared} {long}"])
    words = split_words(texts, SPACED)
    phrase = np.unique(joined(words.hash[1:41], phrases.SIZE).view(np.int64))
    cover = phrases.Shard(words, phrases.SIZE, phrase, np.ones(len(phrase), np.int64), np.array([1, 2])).covered()
    n = len(long.split())
    assert np.flatnonzero(cover).tolist() == list(range(42 + n, 82 + n))


@pytest.mark.parametrize("full", [("th",), ("th", "a", "h", "k")])
def test_repeats_do_not_depend_on_bit_tables(spark, sf_dir, monkeypatch, full):
    """A table full of ones lets all rows pass; no row may be lost by it."""
    real = phrases.bit_table
    monkeypatch.setattr(phrases, "bit_table", lambda values, column: spark.sparkContext.broadcast(np.full(1 << 17, 255, np.uint8)) if column in full else real(values, column))
    test_query_agrees_with_sql(spark, sf_dir, "op9_repeated_phrases")


def test_leaks_are_cut(spark, odd, none):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (None, ""), (2, "short item")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x y Alpha, beta gamma delta epsilon zeta eta theta iota kappa! z q r s t u v w a b c"), (2, "alpha beta"), (3, "a Short-item b c d e"), (4, None)], "doc_id bigint, text string")
    for shard in (5, 50_000):  # one and several automata
        got = {r.doc_id: r.text for r in decontaminate.remove_leaks(docs, items, shard_words=shard).collect()}
        assert got == {1: "x y ! z q r s t u v w a b c", 2: "alpha beta", 3: "a  b c d e", 4: None}
    assert decontaminate.remove_leaks(odd, items.limit(0)).count() == len(ODD) and decontaminate.remove_leaks(none, items).count() == 0


def test_search_skips_no_best_document(spark, odd):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) % 500) for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    asked = spark.createDataFrame([(0, "w1 w40 w7 w300"), (1, None), (None, "w1"), (2, "nothing")], "query_id bigint, text string")
    got = search.top_documents(docs, asked, k=5).orderBy("rank").collect()
    n, mean = len(texts), sum(len(t.split()) for t in texts) / len(texts)
    df = Counter(w for t in texts for w in set(t.split()))
    score = [sum(np.log(1 + (n - df[q] + 0.5) / (df[q] + 0.5)) * t.split().count(q) * 2.2 / (t.split().count(q) + 1.2 * (0.25 + 0.75 * 30 / mean)) for q in ("w1", "w40", "w7", "w300") if df[q]) for t in texts]
    best = sorted((-round(s, 6), i) for i, s in enumerate(score))[:5]
    assert [(r.query_id, r.doc_id, r.score) for r in got] == [(0, i, pytest.approx(-s)) for s, i in best]
    assert search.top_documents(odd, odd.withColumnRenamed("doc_id", "query_id")).count() > 0


@pytest.mark.parametrize("terms", [30, search.GROUP_TERMS])
def test_search_returns_a_few_rows_of_each_task_when_scores_tie(spark, monkeypatch, terms):
    """Hundreds of copies in many tasks: ties rank by id, null last, and a query's results do not grow with tasks or copies."""
    made, real = [], search.materialize
    monkeypatch.setattr(search, "materialize", lambda df, label="stage": made.append((label, real(df, label))) or made[-1][1])
    monkeypatch.setattr(search, "GROUP_TERMS", terms)
    rows = [(i if i % 100 else None, ["red green blue", "red red fox", f"w{i} sky", None][i % 4 if i % 50 else 3]) for i in range(1200)] + [(None, "fox sky sky")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(24)
    asked = [(1, "red green"), (2, "fox sky sky"), (3, "blue red fox"), (3, "red"), (4, "w6"), (5, "absent"), (6, "")]
    got = search.top_documents(docs, spark.createDataFrame(asked, "query_id bigint, text string"), k=7).collect()
    bags = [(i, Counter((t or "").split())) for i, t in rows]
    n, mean, df = len(rows), sum(b.total() for _, b in bags) / len(rows), Counter(w for _, b in bags for w in b)
    wanted = []
    for q in range(1, 7):
        words = [w for i, t in asked if i == q for w in t.split() if df[w]]
        score = lambda b, words=words: sum(np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w in words)
        ranked = sorted((-round(s, 6), i is None, i or 0) for i, b in bags if (s := score(b)) > 0)[:7]
        wanted += [(q, r, None if no else i, pytest.approx(-s, abs=2e-6)) for r, (s, no, i) in enumerate(ranked, 1)]
    assert [tuple(r) for r in sorted(got, key=lambda r: (r.query_id, r.rank))] == wanted
    returned = [df.count() for label, df in made if label.endswith("results")]
    assert 0 < sum(returned) < 300  # 4 queries with words, 7 results each


def test_search_reads_texts_once_for_all_groups_of_queries(spark, monkeypatch):
    """However many groups of queries and slices of documents there are, each text is read and split once."""
    monkeypatch.setattr(search, "GROUP_TERMS", 30)
    texts = ["red green blue", "red red fox", "fox sky", "blue sky green"]
    read = spark.sparkContext.accumulator(0)

    def counted(i):
        read.add(1)
        return i, texts[i % 4] + f" w{i % 7}"

    docs = spark.createDataFrame(spark.sparkContext.parallelize(range(200), 4).map(counted), "doc_id bigint, text string")
    asked = spark.createDataFrame([(i, texts[i % 4] + f" w{i}") for i in range(12)], "query_id bigint, text string")
    got = search.top_documents(docs, asked, k=3).collect()
    assert len(got) == 36 and read.value == 200


def test_search_blocks_score_like_plain_sums(monkeypatch):
    """Small blocks, matrices and products in one process; queries with repeated and absent words, texts without words."""
    for name, value in (("BLOCK_DOCS", 64), ("BLOCK_POSTINGS", 9000), ("LEAST_DOCS", 16), ("CELLS", 64), ("PRODUCT", 300), ("SLOT_BITS", 4)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(8)
    texts = [" ".join(f"{'ab'[i % 2]}{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 300) for i in range(700)] + ["", "..."]
    asked = [(i, f"{texts[i]} {texts[i + 7]} absent") for i in range(0, 60, 5)]
    terms = pa.Table.from_batches(search._query_terms([pa.record_batch({"q": [q for q, _ in asked], "text": [t for _, t in asked]})]))
    words = np.unique(terms.column("term").to_numpy().view(np.uint64))
    batches = [pa.record_batch({"id": np.arange(i, min(i + 100, 702)), "text": texts[i : i + 100], "part": np.zeros(len(texts[i : i + 100]), np.int32)}) for i in range(0, 702, 100)]
    blocks = list(search._index(SimpleNamespace(value=words))(batches))
    held = [len(b.column("sizes")[0].as_py()) // 8 for b in blocks]
    assert len(blocks) > 10 and max(held) <= 64 and sum(held) <= 700 and sum(b.column("docs")[0].as_py() for b in blocks) == 702
    df = np.zeros(len(words), np.int64)
    for b in search._frequencies(len(words))([b.select(["terms", "counts"]) for b in blocks]):
        df[b.column("place").to_numpy()] += b.column("n").to_numpy()
    mean = sum(b.column("words")[0].as_py() for b in blocks) / 702
    group = search._group(SimpleNamespace(toArrow=lambda: terms.rename_columns(["q", "term", "qtf"])), words, df, 702, mean)
    found = search._search(SimpleNamespace(value=group), SimpleNamespace(value=search.Best.of(group.query, 6, None)))(iter(blocks))
    got = pa.Table.from_batches(found).sort_by("query_id").to_pylist()
    bags = [Counter(re.findall(r"\w+", t)) for t in texts]
    many = Counter(w for b in bags for w in b)
    assert mean == sum(b.total() for b in bags) / 702
    wanted = []
    for q, text in asked:
        score = lambda b, ask=Counter(text.split()): sum(m * np.log(1 + (702 - many[w] + 0.5) / (many[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w, m in ask.items() if w in b)
        ranked = sorted((-round(s, 6), i) for i, b in enumerate(bags) if (s := score(b)) > 0)[:6]
        wanted += [(q, i, pytest.approx(-s, abs=2e-6)) for s, i in ranked]
    assert [(r["query_id"], r["doc_id"], r["score"]) for r in got] == wanted


def test_pipeline_runs_and_stages_keep_columns(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, sf_dir)
        assert held.columns == docs.columns, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name
        assert stage(spark, odd, sf_dir).count() <= 3 * len(ODD), name
    out = corpus_pipeline.run(spark, sf_dir)
    assert 0 < out.count() and set(docs.columns) <= set(out.columns)
