"""Run registered queries against their SQL twins in DuckDB.

    python tools/check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinia.plans import ORACLES, QUERIES  # noqa: E402
from affinia.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--diff", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="check-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in glob.glob(f"{args.sf}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = []
    for name, run in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        started = time.time()
        try:
            df = run(spark, args.sf)
            rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
        except Exception as error:  # report and go on
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
            bad.append(name)
            continue
        took = time.time() - started
        if name not in ORACLES:
            print(f"rows {name} {len(rows)} {took:.1f}s", flush=True)
            if not rows:
                bad.append(name)
            continue
        started = time.time()
        try:
            result = db.execute(ORACLES[name])
            columns = [c[0] for c in result.description]
            expected = [tuple(r[i] for i in sorted(range(len(columns)), key=lambda i: columns[i])) for r in result.fetchall()]
        except Exception as error:
            print(f"SQL FAIL {name}: {str(error)[:600]}", flush=True)
            bad.append(name)
            continue
        sql_took = time.time() - started
        ours = sorted(tuple(plain(v) for v in r) for r in rows)
        theirs = sorted(tuple(plain(v) for v in r) for r in expected)
        same = ours == theirs and sorted(df.columns) == sorted(columns)
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(rows)}/{len(expected)} spark {took:.1f}s sql {sql_took:.1f}s"
              + ("" if rows else " EMPTY"), flush=True)
        if not same:
            bad.append(name)
            a, b = set(ours) - set(theirs), set(theirs) - set(ours)
            print("   columns", sorted(df.columns), sorted(columns), "only ours", len(a), sorted(a)[:3], "only sql", len(b), sorted(b)[:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()
