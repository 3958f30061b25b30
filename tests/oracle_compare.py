"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]

Comparison: row count, sorted column names, and the sorted multiset of
rows, exact (floats bit for bit; NaN equals NaN; timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e

    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as ex:  # noqa: BLE001
            results[name] = ("spark-error", str(ex)[:400])
            if verbose:
                print(f"{name:30s} SPARK ERROR {str(ex)[:300]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            print(f"{name:30s} rows-only {len(srows)}")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = ("sql-error", str(ex)[:400])
            if verbose:
                print(f"{name:30s} SQL ERROR {str(ex)[:300]}")
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_v = ok_cols and ok_n and _rows(scols, srows) == _rows(dcols, drows)
        status = "ok" if ok_v else "MISMATCH"
        results[name] = (status, len(srows), len(drows))
        if verbose:
            print(f"{name:30s} {status:8s} spark={len(srows)} duck={len(drows)} cols={'ok' if ok_cols else (sorted(scols), sorted(dcols))} {ts:.1f}s")
            if not ok_v and ok_cols:
                a, b = _rows(scols, srows), _rows(dcols, drows)
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck :", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from shelfgate.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("BAD:", bad)
