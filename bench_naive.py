"""Operators next to a naive form of the same work.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_COPIES how often the rows are
repeated under new keys, to see how both forms grow. Prints one JSON line.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import json
import os
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom import scratch_path, session
from rowloom.operators import aggregate as A
from rowloom.operators import change as M
from rowloom.operators import quality as Q
from rowloom.operators.history import scd2
from rowloom.operators.keys import first_per_key, number_rows


def _drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _grown(spark, sf_dir: str, copies: int, table: str, *keys: str) -> DataFrame:
    """The table, its rows repeated with shifted keys, written once for all runs."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if copies == 1:
        return df
    path = scratch_path(spark, f"grown-{table}")
    copy = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartition(64)
    copy.withColumns({k: F.col(k) + F.col("_copy") * 100_000_000 for k in keys}).drop("_copy").write.parquet(path)
    return spark.read.parquet(path)


def _pandas_diff(source: DataFrame, target: DataFrame) -> int:
    """Row loop over both sides in one process."""
    def hashes(df: DataFrame) -> dict:
        found = {}
        for _, row in df.toPandas().iterrows():
            text = "||".join(str(row[c]) for c in ("o_custkey", "o_orderstatus", "o_totalprice"))
            found[row["o_orderkey"]] = hashlib.md5(text.encode()).hexdigest()
        return found

    a, b = hashes(source), hashes(target)
    return sum(a[k] != b[k] for k in a.keys() & b.keys())


def cases(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> dict:
    late = F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz")
    cut = F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")
    target = orders.filter(F.col("o_orderdate") < cut)
    source = orders.filter(F.col("o_orderdate") >= late).withColumn("o_orderstatus", F.lit("C"))
    daily = orders.filter(F.col("o_orderdate") >= F.lit(dt.datetime(2001, 7, 25)).cast("timestamp_ntz"))
    changed = orders.withColumn("o_orderstatus", F.when(F.col("o_orderpriority") == "2-HIGH", "X").otherwise(F.col("o_orderstatus")))
    keys = ["l_orderkey", "l_linenumber"]
    compared = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]

    def profile_naive() -> None:
        lines.count()
        for column in lines.columns:
            lines.filter(F.col(column).isNull()).count()

    def full_outer_upsert(into: DataFrame, rows: DataFrame) -> None:
        s = rows.select(F.col("o_orderkey").alias("k"), F.struct(*rows.columns).alias("n"))
        joined = into.join(s, into.o_orderkey == s.k, "full")
        _drain(joined.select(*[F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(c)).alias(c) for c in orders.columns]))

    def scd2_naive() -> None:
        """Change sets counted one by one, as separate jobs, and a window over all rows for keys."""
        hashed = customers.withColumn("h", F.md5(F.concat_ws("||", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")))
        after = customers.filter("c_nationkey <> 24").withColumn("c_mktsegment", F.expr("if(c_acctbal < 0, 'HOUSEHOLD', c_mktsegment)"))
        after = after.withColumn("h", F.md5(F.concat_ws("||", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")))
        first = hashed.withColumn("sk", F.row_number().over(Window.orderBy("c_custkey")))
        j = after.alias("s").join(first.alias("t"), F.col("s.c_custkey") == F.col("t.c_custkey"), "full")
        new, gone = j.filter("t.c_custkey is null"), j.filter("s.c_custkey is null")
        diff = j.filter("s.h <> t.h")
        for part in (new, diff, gone, diff, gone):
            part.count()
        _drain(diff.select("s.*").withColumn("sk", F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))))
        _drain(first.join(diff.select("s.c_custkey"), "c_custkey", "left"))
        _drain(first.join(gone.select("t.c_custkey"), "c_custkey", "left"))

    def scd2_ours() -> None:
        kept = customers.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
        options = {"key": "c_custkey", "surrogate": "sk", "tracked": ["c_name", "c_nationkey", "c_mktsegment"]}
        day1 = scd2(None, kept, now=dt.datetime(2025, 1, 1), **options)
        after = kept.filter("c_nationkey <> 24").withColumn("c_mktsegment", F.expr("if(c_acctbal < 0, 'HOUSEHOLD', c_mktsegment)"))
        _drain(scd2(day1, after, now=dt.datetime(2026, 1, 1), **options))

    return {
        "profile": (lambda: _drain(A.profile(lines)), profile_naive),
        "row_number_all": (
            lambda: _drain(number_rows(lines, "n", ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"])),
            lambda: _drain(lines.withColumn("n", F.row_number().over(Window.orderBy("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")))),
        ),
        "first_per_key": (
            lambda: _drain(first_per_key(lines, keys, ["l_partkey", "l_suppkey", "l_shipdate"])),
            lambda: _drain(lines.dropDuplicates(keys)),
        ),
        "upsert_large_source": (lambda: _drain(M.upsert(target, source, ["o_orderkey"])), lambda: full_outer_upsert(target, source)),
        "upsert_small_source": (lambda: _drain(M.upsert(orders, daily, ["o_orderkey"])), lambda: full_outer_upsert(orders, daily)),
        "data_diff": (
            lambda: _drain(Q.diff_summary(Q.diff_rows(orders.select(*compared), changed.select(*compared), ["o_orderkey"]), "o", ["o_orderkey"])),
            lambda: _pandas_diff(orders.select(*compared), changed.select(*compared)),
        ),
        "scd2": (scd2_ours, scd2_naive),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, copies = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_COPIES", "1"))
    skip = set(os.environ.get("BENCH_SKIP", "").split(","))
    spark = session("bench-naive", f"local[{cpus}]", spark__sql__shuffle__partitions="16", spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    with contextlib.redirect_stdout(sys.stderr):
        orders = _grown(spark, sf_dir, copies, "orders", "o_orderkey", "o_custkey")
        lines = _grown(spark, sf_dir, copies, "lineitem", "l_orderkey")
        customers = _grown(spark, sf_dir, copies, "customer", "c_custkey")
        for name, forms in cases(orders, lines, customers).items():
            times[name] = {}
            for label, form in zip(("ours", "naive"), forms):
                if f"{name}:{label}" in skip:
                    continue
                form()  # warm
                start = time.perf_counter()
                form()
                times[name][label] = round(time.perf_counter() - start, 2)
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"copies": copies, "lines": lines.count(), "seconds": times}))
    spark.stop()


if __name__ == "__main__":
    main()
