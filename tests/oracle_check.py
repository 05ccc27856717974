"""Run registered queries next to their DuckDB statement and compare schema and values.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    import duckdb
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float) and v == 0:
        return 0.0
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
              "date": "DATE", "float": "FLOAT"}


def compare(spark, con, fn, sql: str, folder: str) -> list[str]:
    """Differences between the Spark result and the DuckDB result; empty when equal."""
    df = fn(spark, folder)
    rel = con.sql(sql)
    problems = []
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns differ: only spark {set(df.columns) - set(rel.columns)}, "
                f"only sql {set(rel.columns) - set(df.columns)}"]
    kinds = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in df.schema.fields:
        want = TYPE_NAMES.get(f.dataType.simpleString())
        if want and kinds[f.name].split(" WITH")[0] != want:
            problems.append(f"type of {f.name}: spark {f.dataType.simpleString()}, sql {kinds[f.name]}")
    left = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    order = [rel.columns.index(n) for n in names]
    right = [tuple(plain(row[i]) for i in order) for row in rel.fetchall()]
    if len(left) != len(right):
        problems.append(f"rows: spark {len(left)}, sql {len(right)}")
    key = lambda row: tuple((v is None, str(type(v)), str(v)) for v in row)
    left.sort(key=key)
    right.sort(key=key)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(bad)} of {len(left)} rows differ, first: {diff}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from hexloom.session import build_session
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connect(args.sf)
    failed = 0
    for name in args.names or queries:
        t0 = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, queries[name], oracles[name], args.sf)
                state = "ok" if not problems else "DIFF"
            else:
                problems, state = [], f"rows {queries[name](spark, args.sf).count()} (no sql)"
        except Exception as exc:
            problems, state = [f"{type(exc).__name__}: {str(exc)[:600]}"], "ERROR"
        failed += state in ("DIFF", "ERROR")
        print(f"{name:32s} {state:8s} {time.time() - t0:6.2f}s", *problems, sep="  ", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
