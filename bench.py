"""Time every query once, warm, and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (optional,
comma-separated) the queries.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import sys
import time

from rowloom import session
from rowloom.plans import QUERIES


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to plan the query and compute every row; rows go nowhere."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, failed = {}, {}
    with contextlib.redirect_stdout(sys.stderr):
        run(spark, "agg_revenue", sf_dir)
        run(spark, "row_code", sf_dir)
        for name in names:
            try:
                seconds[name] = round(run(spark, name, sf_dir), 3)
            except Exception as error:  # one failure must not hide the other times
                failed[name] = str(error)[:200]
    found = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(found.group(1)) if found else sf_dir,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
