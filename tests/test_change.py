import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowloom import constants as C
from rowloom.operators import change as M
from rowloom.operators import incremental as I
from rowloom.operators.history import history_log, load_history, read_history, scd2

SCHEMA = "id int, v string"
T0, T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1), dt.datetime(2025, 3, 1)


@pytest.fixture(params=["-1", "10MB"], autouse=True)
def limit(spark, request):
    """Every test with sources that are broadcast, and with sources that are too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "n")], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], SCHEMA)


def test_actions(target, source, rows):
    keys = ["id"]
    assert rows(M.apply_action(target, source, keys, "insert")) == rows(target.union(source))
    assert rows(M.apply_action(target, source, keys, "update")) == [(1, "a"), (2, "B"), (2, "B"), (None, "n")]
    upserted = [(1, "a"), (2, "B"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    for name in ("UPSERT", "insert_or_update", "Update_Or_Insert"):
        assert rows(M.apply_action(target, source, keys, name)) == upserted
    assert rows(M.apply_action(target, source, keys, "delete")) == [(1, "a"), (None, "n")]
    replaced = [(1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    assert rows(M.apply_action(target, source, keys, "delete_insert")) == replaced


def test_unknown_action(target, source):
    with pytest.raises(ValueError):
        M.apply_action(target, source, ["id"], "TRUNCATE")


def test_repeated_source_key_fails_or_is_ordered(spark, target, rows):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows for key"):
        M.upsert(target, twice, ["id"]).collect()
    assert (2, "y") in rows(M.upsert(target, twice, ["id"], [F.desc("v")]))


def test_upsert_twice_changes_nothing_and_equals_delete_insert_on_unique_keys(spark, source, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    keyed = source.filter("id is not null")
    once = M.upsert(target, keyed, ["id"])
    assert rows(once) == rows(M.upsert(once, keyed, ["id"])) == rows(M.delete_insert(target, keyed, ["id"]))


def test_columns_must_agree(target, spark):
    with pytest.raises(ValueError):
        M.upsert(target, spark.createDataFrame([(1, 2)], "id int, w int"), ["id"])


def test_scd1_keeps_columns_of_the_target(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, v string, extra double")
    source = spark.createDataFrame([(2, None), (3, "c")], SCHEMA)
    assert rows(M.scd1(target, source, ["id"])) == [(1, "a", 1.0), (2, None, 2.0), (3, "c", None)]


def test_source_is_evaluated_once(spark, rows):
    """A source that gives other rows each time it is evaluated still gives one state."""
    target = spark.range(1000).select(F.col("id").cast("int"), F.lit("t").alias("v"))
    source = spark.range(500, 1500).select(F.col("id").cast("int"), F.uuid().alias("v"))
    state = M.upsert(target, source, ["id"])
    assert rows(state) == rows(state) and state.count() == 1500 and state.filter("v = 't'").count() == 500


def test_many_rows_of_a_hot_key_are_updated_once_each(spark, rows):
    hot = [(7, f"h{i}") for i in range(3000)] + [(None, "n")] * 500
    target = spark.createDataFrame([*hot, *[(i, "o") for i in range(100, 300)]], SCHEMA).repartition(6)
    source = spark.createDataFrame([(7, "H"), (100, "O"), (5000, "new"), (None, "k"), (None, "k")], SCHEMA)
    expected = sorted([(7, "H")] * 3000 + [(100, "O"), (5000, "new")] + [(i, "o") for i in range(101, 300)], key=str)
    got = M.upsert(target, source, ["id"])
    assert sorted(map(tuple, got.filter("id IS NOT NULL").collect()), key=str) == expected
    assert {(r.v, r["count"]) for r in got.filter("id IS NULL").groupBy("v").count().collect()} == {("n", 500), ("k", 2)}
    gone = M.apply_deletes(target, source.withColumn("d", F.col("id").isin(7, 5000)), ["id"], "d")
    assert gone.filter("id = 7 OR id = 5000").count() == 0 and gone.count() == 200 + 500 + 2
    assert M.hot_keys(target, ["id"], 8).count() == 1 and M.hot_keys(target.filter("id >= 100"), ["id"], 8) is None


def test_deletes_by_flag(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    source = spark.createDataFrame([(1, "x", True), (2, "y", None), (3, "z", False), (4, "q", True)], SCHEMA + ", gone boolean")
    assert rows(M.apply_deletes(target, source, ["id"], "gone")) == [(2, "y"), (3, "z")]


def test_first_load(source, rows):
    assert rows(M.apply_action(None, source, ["id"], "upsert")) == rows(source)
    assert M.apply_action(None, source, ["id"], "delete").count() == 0


def _dim(df):
    return sorted(
        ((r.id, r.v, r[C.VALID_FROM], r[C.VALID_TO], r[C.IS_CURRENT], r.sk) for r in df.collect()), key=lambda r: r[-1]
    )


def test_scd2_life_of_a_key(spark):
    options = {"key": "id", "surrogate": "sk", "source_name": "s"}
    day1 = scd2(None, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), now=T0, **options)
    assert _dim(day1) == [(1, "a", T0, C.OPEN_END, True, 1), (2, "b", T0, C.OPEN_END, True, 2)]
    day2 = scd2(day1, spark.createDataFrame([(1, "A"), (3, "c")], SCHEMA), now=T1, **options)
    assert _dim(day2) == [
        (1, "a", T0, T1, False, 1), (2, "b", T0, T1, False, 2), (1, "A", T1, C.OPEN_END, True, 3), (3, "c", T1, C.OPEN_END, True, 4),
    ]
    # the closed key comes back as new, the rest is untouched
    day3 = scd2(day2, spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], SCHEMA), now=T2, **options)
    assert _dim(day3) == [*_dim(day2), (2, "b", T2, C.OPEN_END, True, 5)]
    current = day3.filter(C.IS_CURRENT).select("id", "v")
    assert sorted(map(tuple, current.collect())) == [(1, "A"), (2, "b"), (3, "c")]


def test_scd2_can_leave_missing_keys_open_and_track_some_columns(spark):
    schema = "id int, v string, note string"
    options = {"key": "id", "surrogate": "sk", "tracked": ["v"], "close_missing": False}
    day1 = scd2(None, spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], schema), now=T0, **options)
    day2 = scd2(day1, spark.createDataFrame([(1, "a", "other")], schema), now=T1, **options)
    assert day2.filter(C.IS_CURRENT).count() == 2 and day2.count() == 2


def _files(path):
    return {str(f.relative_to(path)): (f.stat().st_mtime_ns, f.read_bytes()) for f in sorted(path.rglob("*.parquet"))}


def test_stored_history_agrees_and_leaves_closed_versions_alone(spark, tmp_path):
    options = {"key": "id", "surrogate": "sk", "source_name": "s"}
    snapshots = [[(1, "a"), (2, "b"), (4, None), (None, "k")], [(1, "A"), (3, "c"), (4, None)], [(1, "A"), (2, "b"), (3, "c"), (4, "d")], [(1, "A"), (2, "b"), (3, "c"), (4, "d")], []]
    state, path = None, f"{tmp_path}/h"
    for n, (rows_, now) in enumerate(zip(snapshots, (T0, T1, T2, dt.datetime(2025, 4, 1), dt.datetime(2025, 5, 1)), strict=True), 1):
        source = spark.createDataFrame(rows_, SCHEMA)
        before = _files(tmp_path / "h" / "closed") if n > 2 else {}
        state = scd2(state, source, now=now, **options)
        assert load_history(spark, path, source, now=now, **options) == n
        assert _dim(read_history(spark, path)) == _dim(state)
        after = _files(tmp_path / "h" / "closed") if n > 2 else {}
        assert all(after[f] == before[f] for f in before)
    log = {r.load: (r.opened, r.closed) for r in history_log(spark, path).collect()}
    assert log == {1: (4, 0), 2: (2, 3), 3: (2, 1), 4: (0, 0), 5: (0, 4)}
    assert len(_dim(read_history(spark, path, 1))) == 4 and len(_dim(read_history(spark, path, 3))) == 8
    with pytest.raises(ValueError):
        read_history(spark, path, 9)


def test_a_load_that_fails_leaves_the_history_as_it_was(spark, tmp_path):
    options = {"key": "id", "surrogate": "sk"}
    path = f"{tmp_path}/h"
    load_history(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), now=T0, **options)
    good = _dim(read_history(spark, path))
    # files of a second load that never came to its log
    read_history(spark, path).write.parquet(f"{path}/closed/load=2")
    read_history(spark, path).write.parquet(f"{path}/current/load=2")
    assert _dim(read_history(spark, path)) == good
    with pytest.raises(Exception, match="several source rows for key"):
        load_history(spark, path, spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), now=T1, **options)
    assert _dim(read_history(spark, path)) == good
    load_history(spark, path, spark.createDataFrame([(1, "a"), (2, "B")], SCHEMA), now=T1, **options)
    assert [(r[0], r[1], r[4]) for r in _dim(read_history(spark, path))] == [(1, "a", True), (2, "b", False), (2, "B", True)]


def _orders(spark, *items):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(at)) for i, at in items], "id int, at timestamp_ntz")


def test_watermark_run_by_run(spark, rows):
    source = _orders(spark, (1, "2025-01-01"), (2, "2025-01-02"))
    run1 = I.watermark_load(source, None, I.empty_control(spark), "t", ["id"], "at", T0)
    assert run1.target.count() == 2
    assert rows(run1.control, "table_name", "last_watermark") == [("t", "2025-01-02 00:00:00")]
    # strict: the row at the watermark is not read again, nothing changes
    run2 = I.watermark_load(source, run1.target, run1.control, "t", ["id"], "at", T1)
    assert run2.changes.count() == 0
    assert rows(run2.target) == rows(run1.target) and rows(run2.control) == rows(run1.control)
    later = _orders(spark, (1, "2025-01-05"), (2, "2025-01-02"), (3, "2025-01-02"))
    run3 = I.watermark_load(later, run2.target, run2.control, "t", ["id"], "at", T2)
    assert rows(run3.target, "id") == [(1,), (2,)]
    # the late row that shares the watermark needs an overlap
    run3 = I.watermark_load(later, run2.target, run2.control, "t", ["id"], "at", T2, overlap="1 day")
    assert rows(run3.target, "id") == [(1,), (2,), (3,)]
    assert rows(run3.control, "last_watermark", "updated_at") == [("2025-01-05 00:00:00", T2)]


def test_other_tables_keep_their_watermark(spark, rows):
    control = spark.createDataFrame([("other", "2020-01-01 00:00:00", T0)], C.WATERMARK_COLUMNS)
    run = I.watermark_load(_orders(spark, (1, "2025-01-01")), None, control, "t", ["id"], "at", T1)
    assert rows(run.control, "table_name", "last_watermark") == [("other", "2020-01-01 00:00:00"), ("t", "2025-01-01 00:00:00")]


def test_target_watermark_defaults(spark):
    assert I.target_watermark(None, "at") == "1900-01-01 00:00:00"
    assert I.target_watermark(_orders(spark, (1, "2025-01-01")).limit(0), "at") == "1900-01-01 00:00:00"


def test_date_slice_mode(spark):
    source = _orders(spark, (1, "2025-01-01"), (2, "2025-01-02"))
    kept, mode = I.date_slice(source, "at", "2025-01-02")
    assert (kept.count(), mode) == (1, "append")
    everything, mode = I.date_slice(source, "at", "2025-01-02", full=True)
    assert (everything.count(), mode) == (2, "overwrite")
