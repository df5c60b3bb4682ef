"""Run registered queries against DuckDB on the same Parquet tables.

Usage: python -m tests.compare [sf0.01] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

import __spark_entry__ as entry
from cohorts.session import build_session, clear_scratch

TESTDATA = "/root/testdata"


def connect(base: str):
    con = duckdb.connect()
    for path in glob.glob(f"{base}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def differences(spark, con, base, name):
    frame = entry.queries()[name](spark, base)
    got, got_columns = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows={len(got)} (no SQL)", None
    cursor = con.execute(sql)
    want, want_columns = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", False
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if len(got) != len(want) or bad:
        return f"rows {len(got)} vs {len(want)}, {len(bad)} differ, first {bad[:1]}", False
    return f"rows={len(got)} equal", True


def main(args: list[str]) -> int:
    sf = args[0] if args else "sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{TESTDATA}/{sf}"
    con = connect(base)
    failed = 0
    for name in entry.queries():
        if args[1:] and not any(name.startswith(p) for p in args[1:]):
            continue
        start = time.time()
        try:
            text, ok = differences(spark, con, base, name)
        except Exception as error:  # noqa: BLE001
            text, ok = f"{type(error).__name__}: {str(error)[:3000]}", False
        failed += ok is False
        print(f"{'BAD ' if ok is False else 'ok  '} {name:22s} {time.time() - start:6.2f}s {text}", flush=True)
    clear_scratch(spark)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
