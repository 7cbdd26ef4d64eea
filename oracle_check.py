"""Run queries next to their SQL in DuckDB and compare: python oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

from rowloom.plans import QUERIES, SQL, TABLES


def _kind(spark_type: str) -> str:
    return "int" if spark_type in ("tinyint", "smallint", "int", "bigint") else spark_type


def _duck_kind(name: str) -> str:
    name = str(name).upper()
    names = {"VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
    return "int" if name in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT") else names.get(name, name.lower())


def _cell(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value.normalize()}"
    if isinstance(value, dt.datetime):
        return value.isoformat(" ", "microseconds")
    return value if value is None or isinstance(value, (bool, str)) else str(value)


def compare(spark, name: str, sf_dir: str) -> str:
    """Empty when rows, columns and types agree; otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in SQL:
        return "" if rows else "no rows"
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = duck.execute(SQL[name])
    theirs_columns = {d[0]: _duck_kind(d[1]) for d in result.description}
    ours_columns = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    theirs = result.fetchall()
    if set(ours_columns) != set(theirs_columns):
        return f"columns {sorted(ours_columns)} vs {sorted(theirs_columns)}"
    problems = []
    if ours_columns != theirs_columns:
        problems.append("types " + str({c: (ours_columns[c], theirs_columns[c]) for c in ours_columns if ours_columns[c] != theirs_columns[c]}))
    order = sorted(ours_columns)
    position = {d[0]: i for i, d in enumerate(result.description)}
    ours_bag = Counter(tuple(_cell(r[c]) for c in order) for r in rows)
    theirs_bag = Counter(tuple(_cell(r[position[c]]) for c in order) for r in theirs)
    if ours_bag != theirs_bag:
        only_ours, only_theirs = list((ours_bag - theirs_bag).elements()), list((theirs_bag - ours_bag).elements())
        problems.append(f"{len(rows)} vs {len(theirs)} rows; {order}; ours {only_ours[:3]}; SQL {only_theirs[:3]}")
    if not rows:
        problems.append("no rows")
    return "; ".join(problems)


def main() -> int:
    from rowloom import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.2f}s {'' if name in SQL else '(rows only) '}{problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
