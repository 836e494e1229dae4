"""Run every query of __spark_entry__ and its SQL oracle in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import decimal
import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from lakeward.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        if key not in sqls:
            print(f"{key:24s} rows={len(rows):6d} spark={t1-t0:5.1f}s  (no oracle)")
            continue
        res = con.execute(sqls[key])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        bad += not ok
        print(f"{key:24s} rows={len(rows):6d}/{len(orows):6d} cols={'ok' if sorted(cols)==sorted(ocols) else (cols, ocols)} "
              f"hash={'ok' if h1==h2 else 'MISMATCH'} spark={t1-t0:5.1f}s")
        if not ok:
            s1, s2 = set(l1), set(l2)
            print("   spark-only:", list(s1 - s2)[:3])
            print("   oracle-only:", list(s2 - s1)[:3])
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
