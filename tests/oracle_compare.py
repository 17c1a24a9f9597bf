"""Run suite queries in Spark and their oracle SQL in DuckDB, then compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Comparison: same row count, same column names, and the same multiset of
rows after normalising values (timestamps to naive datetimes, decimals to
Decimal, floats exact; float near-misses are reported separately).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), repr(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols) -> tuple[bool, str]:
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={spark_cols} duck={duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return False, f"row count differs: spark={len(spark_rows)} duck={len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if s == d:
        return True, "equal"
    diffs = [(a, b) for a, b in zip(s, d) if a != b]
    close = all(
        all((x == y) or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9))
            for x, y in zip(a, b))
        for a, b in diffs)
    return False, f"{'CLOSE' if close else 'VALUES'} differ in {len(diffs)} rows, e.g. {diffs[:2]}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from sluice.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    bad = 0
    for name in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as exc:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:28s} rows-only {len(rows)} rows ({ts:.2f}s)")
            continue
        try:
            rel = con.execute(sql[name])
            dcols = [c[0] for c in rel.description]
            drows = rel.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {exc}")
            bad += 1
            continue
        ok, msg = compare(rows, cols, drows, dcols)
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {len(rows)} rows ({ts:.2f}s) {'' if ok else msg}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
