"""The stages of the pipeline on planted rows, next to plain Python."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from rowloom.llm import mixing


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _shingles(text, n=5):
    w = _words(text)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghijklmnoprstuvw", k=draw.randint(2, 9))) for _ in range(600)]
    prose = lambda n: " ".join(draw.choices(vocabulary, k=n))
    item = prose(25)
    texts = {i: prose(draw.randint(40, 160)) for i in range(40)}
    texts[50] = texts[3]  # a copy
    near = texts[7].split()
    near[len(near) // 2] = "changed"
    texts[51] = " ".join(near) + " " + prose(1)
    texts[52] = f"{prose(40)} {item} {prose(30)}"
    texts[53] = item
    texts[54] = f"{prose(50)} write to jo.e+x@mail.example.org or 10.0.0.7 {prose(10)}"
    texts |= {60: None, 61: "", 62: "12 34 -- !!"}
    rows = [(i, t, "en" if i % 3 else None, ("a", "b", None)[i % 3], len(t or "")) for i, t in texts.items()]
    folder = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, item


def test_stages_agree_with_plain_python(spark, planted):
    folder, texts, item = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "deduplicate", "decontaminate", "personal_data", "mix"]

    def texts_of(df):
        return {r.doc_id: r.text for r in df.collect()}

    kept = {i: t for i, t in texts.items() if re.search("[A-Za-z]", t or "")}
    named = stage["language"](spark, docs, folder)
    assert texts_of(named) == kept

    sets = {i: _shingles(t) for i, t in kept.items()}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    linked = [(a, b) for a in sets for b in sets if a < b and alike(a, b)]
    assert (3, 50) in linked and (7, 51) in linked and len(linked) == 2
    kept = {i: t for i, t in kept.items() if i not in {b for _, b in linked}}
    single = stage["deduplicate"](spark, named, folder)
    assert texts_of(single) == kept

    clean = stage["decontaminate"](spark, single, folder)
    got = texts_of(clean)
    assert 53 not in got and set(got) == set(kept) - {53}
    cut = _words(kept[52])
    at = cut.index(_words(item)[0])
    while cut[at : at + 25] != _words(item):
        at = cut.index(_words(item)[0], at + 1)
    assert _words(got[52]) == cut[:at] + cut[at + 25 :]
    assert all(got[i] == kept[i] for i in got if i != 52)

    masked = texts_of(stage["personal_data"](spark, clean, folder))
    assert masked == {**got, 54: got[54].replace("jo.e+x@mail.example.org", "[EMAIL]").replace("10.0.0.7", "[IP]")}

    mixed = stage["mix"](spark, spark.createDataFrame([(i, t, None, ("a", "b", None)[i % 3], 0) for i, t in masked.items()], docs.schema), folder).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in masked.items()}
    source = {i: ("a", "b", None)[i % 3] for i in masked}
    totals = Counter()
    for i, n in size.items():
        totals[source[i]] += n
    weight = {"a": 1, "b": 2, None: 3}
    target, capped = {}, set()
    while True:  # water-filling
        rest = sum(totals.values()) - sum(3 * totals[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in totals if x not in capped) for s in totals if s not in capped}
        over = {s for s, t in share.items() if t >= 3 * totals[s]}
        if not over:
            break
        capped |= over
    target = {**{s: 3 * totals[s] for s in capped}, **share}
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 3
    for s in totals:
        assert abs(sum(n * size[i] for i, n in times.items() if source[i] == s) - target[s]) <= max(size.values())


def test_run_gives_what_the_stages_give(spark, planted):
    folder, texts, _ = planted
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} <= set(texts) - {50, 51, 53, 60, 61, 62} and not any("jo.e+x" in r.text for r in out)
    assert out and mixing.mixed(spark.read.parquet(f"{folder}/documents.parquet")).columns[0] == "repetition"
