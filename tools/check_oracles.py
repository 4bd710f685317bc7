"""Compare registered queries with their SQL: python tools/check_oracles.py [sf] [key ...]."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textmill.registry import all_oracles, all_queries  # noqa: E402
from textmill.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf):
    started = time.time()
    df = fn(spark, sf)
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows (no SQL), {took:.1f}s"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    want = as_rows(columns, result.fetchall())
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} vs {len(want)} rows; got {str(extra)[:600]} want {str(missing)[:600]}"
    return True, f"{len(got)} rows, {took:.1f}s"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracles-"),
                                                  "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    queries, oracles = all_queries(), all_oracles()
    bad = []
    for key in keys or queries:
        try:
            ok, note = compare(spark, con, key, queries[key], oracles.get(key), sf)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print("ok  " if ok else "FAIL", key, note, flush=True)
        if not ok:
            bad.append(key)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main()
