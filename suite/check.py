"""Run registered queries against their DuckDB text: ``python -m suite.check [sf_dir] [name part …]``."""
from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

from suite import base


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in base.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        f = float(v)
        return None if math.isnan(f) else f + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b
    return a == b


def compare(spark, con, sf: str, name: str) -> str:
    t = time.time()
    df = base.QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - t
    if name not in base.ORACLES:
        return f"rows-only {len(got)} rows {spent:.1f}s"
    t = time.time()
    cur = con.execute(base.ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    took = time.time() - t
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(got) != len(want):
        return f"FAIL rows {len(got)} vs {len(want)}\n   first {got[:2]}\n   want  {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if not all(same(x, y) for x, y in zip(g, w))]
    if bad:
        return f"FAIL values {len(bad)} of {len(got)}: {sorted(columns)}\n   got  {bad[0][0]}\n   want {bad[0][1]}"
    return f"ok {len(got)} rows {spent:.1f}s / {took:.1f}s"


def main() -> int:
    import suite.all  # noqa: F401
    from zonaria.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in base.QUERIES:
        if args and not any(a.lower() in name.lower() for a in args):
            continue
        try:
            result = compare(spark, con, sf, name)
        except Exception as ex:  # noqa: BLE001
            result = f"FAIL {type(ex).__name__}: {str(ex)[:700]}"
        failed += result.startswith("FAIL")
        print(name, result, flush=True)
    print("failed", failed, "of", len(base.QUERIES))
    return failed


if __name__ == "__main__":
    sys.exit(main())
