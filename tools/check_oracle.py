"""Run registered queries on Spark and their SQL on DuckDB and compare rows.

Usage: python tools/check_oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import importlib.util
import pathlib
import sys
import time
import traceback

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tablebridge.plans.registry import TABLES  # noqa: E402
from tablebridge.session import local_session  # noqa: E402


def normal(v):
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    queries, oracles = entry.queries(), entry.oracle_sql()
    folder = f"/root/testdata/sf{opts.sf}"
    spark = local_session(partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = []
    for name in opts.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            mine = rows_of(df.columns, df.collect())
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name}: {len(mine)} rows {took:.2f}s")
                continue
            cur = db.execute(oracles[name])
            cols = [d[0] for d in cur.description]
            kinds = {d[0]: str(d[1]) for d in cur.description}
            want = rows_of(cols, cur.fetchall())
            if sorted(cols) != sorted(df.columns):
                bad.append(name)
                print(f"BAD   {name}: columns {sorted(df.columns)} vs {sorted(cols)}")
            elif mine != want:
                bad.append(name)
                a, b = set(map(str, mine)), set(map(str, want))
                print(f"BAD   {name}: {len(mine)} vs {len(want)} rows; columns {sorted(cols)}")
                print("      only spark:", sorted(a - b)[:3])
                print("      only sql:  ", sorted(b - a)[:3])
            else:
                odd = {f: k for f, k in kinds.items() if "HUGEINT" in k or "INT128" in k}
                print(f"ok    {name}: {len(mine)} rows {took:.2f}s {odd or ''}")
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL  {name}: {str(e)[:600]}")
            if opts.names:
                traceback.print_exc()
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
