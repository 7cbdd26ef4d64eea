"""Matching against brute force on small fixtures."""

import random
import string

import duckdb
import pytest

from rowloom.operators import matching as X


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _words(seed, n):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(n)})


def test_similar_values_finds_every_pair(spark):
    a, b = _words(1, 80), _words(2, 80)
    left = spark.createDataFrame([(w,) for w in a for _ in range(2)], "a string")
    right = spark.createDataFrame([(w,) for w in b] + [(None,)], "b string")
    for limit in (0, 1, 2):
        want = {(x, y, edits(x, y)) for x in a for y in b if edits(x, y) <= limit}
        got = [tuple(r) for r in X.similar_values(left, right, "a", "b", limit).collect()]
        assert len(got) == len(set(got)) and set(got) == want, limit


def test_copies_of_one_value_do_not_multiply(spark):
    # a third of all rows is one value: pairs are of values, so their number does not grow
    rows = [("same name",)] * 3000 + [(f"name {i}",) for i in range(100)]
    df = spark.createDataFrame(rows, "name string")
    assert X.similar_values(df, df, "name", "name", 1).filter("left_value = 'same name'").count() == 1
    assert X.match_groups(df, "name", 1).count() == len(rows)


def test_fuzzy_lookup_takes_the_closest(spark, rows):
    main = spark.createDataFrame([(1, "jon"), (2, "smith"), (3, "zzz"), (4, None)], "id int, name string")
    table = spark.createDataFrame([("john",), ("jonn",), ("smyth",), ("smith",)], "n string")
    got = rows(X.fuzzy_lookup(main, table, "name", "n", 1), "id", "match_value", "match_distance")
    assert got == [(1, "john", 1), (2, "smith", 0), (3, None, None), (4, None, None)]


def _components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return {x: find(x) for x in parent}


def test_connected_groups(spark):
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(300, 360)]
    star = [(1000, i) for i in range(1001, 1100)]
    loose = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)]
    edges = [*chain, *star, *loose, (5000, 5000)]
    got = {r.node: r.group for r in X.connected_groups(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert got == _components(edges)


def test_match_groups_link_through_others(spark, rows):
    names = ["aaaa", "aaab", "aabb", "zzzz", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    assert rows(X.match_groups(df, "name", 1), "id", "match_group") == [(0, "aaaa"), (1, "aaaa"), (2, "aaaa"), (3, "zzzz"), (4, None)]


def test_survivors(spark, rows):
    df = spark.createDataFrame(
        [(1, "Al", "x", 1), (1, "Albert", "y", 2), (1, None, "y", 3), (2, None, None, None), (None, "N", "n", 1)],
        "g int, name string, city string, at int",
    )
    rules = {"name": ("longest", None), "city": ("most_common", None), "at": ("highest", None)}
    assert rows(X.survivors(df, ["g"], rules)) == [(1, "Albert", "y", 3), (2, None, None, None), (None, "N", "n", 1)]
    newest = X.survivors(df, ["g"], {"name": ("latest", "at")})
    assert rows(newest) == [(1, "Albert"), (2, None), (None, "N")]


def _near_plainly(left, right, distance):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE a AS SELECT unnest(?) AS x", [sorted(set(left))])
    duck.execute("CREATE TABLE b AS SELECT unnest(?) AS y", [sorted(set(right))])
    return sorted(duck.execute("SELECT x, y, levenshtein(x, y) FROM a, b WHERE abs(len(x) - len(y)) <= $1 AND levenshtein(x, y) <= $1", [distance]).fetchall())


def _changed(draw, text, n):
    for _ in range(n):
        at = draw.randrange(len(text) + 1)
        text = draw.choice([text[:at] + draw.choice("abxyz") + text[at:], text[:at] + text[at + 1 :], text[:at] + draw.choice("abxyz") + text[at + 1 :]])
    return text


@pytest.mark.parametrize("distance", [1, 3])
def test_segments_find_all_pairs(spark, monkeypatch, distance):
    """Texts around the border between variants and segments, and keys that many texts have."""
    draw = random.Random(distance)
    monkeypatch.setattr(X, "VARIANTS", {1: 12, 2: 60, 3: 200}[distance])
    monkeypatch.setattr(X, "HOT_PAIRS", 400)
    base = ["".join(draw.choices("abc", k=draw.randint(0, 40))) for _ in range(60)]
    values = base + [_changed(draw, draw.choice(base), draw.randint(1, distance + 1)) for _ in range(120)]
    left, right = values[:110] + values[:5], values[60:]
    a, b = (spark.createDataFrame([(v,) for v in [*vs, None]], "`my v` string") for vs in (left, right))
    got = sorted(map(tuple, X.similar_values(a, b, "my v", "my v", distance).collect()))
    assert got == _near_plainly(left, right, distance)
    once = sorted(map(tuple, X.similar_pairs(a, "my v", distance).collect()))
    assert once == [p for p in _near_plainly(left, left, distance) if p[0] < p[1]]


def test_long_texts_with_a_common_passage(spark):
    """Five hundred characters at distance 3; all texts share four fifths of them."""
    draw = random.Random(8)
    common = "".join(draw.choices("abcdefgh ", k=400))
    base = [common + "".join(draw.choices("abcdefgh ", k=100)) for _ in range(400)]
    values = base + [_changed(draw, v, 3) for v in base[:100]]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    pairs = X.similar_pairs(frame, "v", 3)
    assert sorted(map(tuple, pairs.collect())) == [p for p in _near_plainly(values, values, 3) if p[0] < p[1]]
    assert X.match_groups(frame, "v", 3).select("match_group").distinct().count() == 400
