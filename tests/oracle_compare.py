"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: row count, column names, and the multiset of rows after
normalising types (floats compared as float32 where the Spark type is float).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 else v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        scols = df.columns
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        t2 = time.time()
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_v = ok_cols and ok_n and rows_of(scols, srows) == rows_of(dcols, drows)
        results[name] = (ok_cols and ok_n and ok_v, len(srows), len(drows))
        if verbose:
            print(f"{name:28s} {'OK ' if results[name][0] else 'BAD'} spark={len(srows)} duck={len(drows)} "
                  f"cols={'ok' if ok_cols else (scols, dcols)} t_spark={t1 - t0:.1f}s t_duck={t2 - t1:.1f}s",
                  flush=True)
            if not ok_v and ok_cols and ok_n:
                a, b = rows_of(scols, srows), rows_of(dcols, drows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                print("   first diffs:", diff)
    return results


if __name__ == "__main__":
    from histdim.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] is False]
    print("BAD:", bad)
