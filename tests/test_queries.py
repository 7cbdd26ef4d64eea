"""Every registered query against its SQL, and the shape of its plan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from oracle_check import compare
from rowloom.operators.incremental import changes_since
from rowloom.plans import QUERIES, SQL

# queries whose rows are caller's Python by design
PYTHON_ROWS = {"batch_code", "staged_code"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert compare(spark, name, sf_dir) == ""


def _plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON_ROWS))
def test_plan_has_no_cross_join_or_python(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan, bad


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_id", "customer_name", "amount", "amount_with_tax"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(SQL) == {"sample_by_hash", "sample_fraction", "sample_rows", "random_n", "data_diff_sampled", "fn_phonetic"}


def test_scans_are_pruned_and_pushed_down(spark, sf_dir):
    plan = _plan(QUERIES["date_slice"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")  # the load itself writes its changes; the filter is in that job
    assert "GreaterThan(o_orderdate" in _plan(changes_since(orders, "o_orderdate", "1999-12-31 00:00:00"))
    plan = _plan(QUERIES["value_count"](spark, sf_dir))
    assert "ReadSchema: struct<p_type:string>" in plan


def test_first_per_key_limits_groups_before_the_exchange(spark, sf_dir):
    plan = _plan(QUERIES["qualify_latest"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") >= 2


def test_merge_with_small_source_does_not_move_the_target(spark, sf_dir):
    plan = _plan(QUERIES["merge_update"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
