"""Run every registered Spark plan and its DuckDB twin and compare them
(row count, column names, order-insensitive values) -- the driver's gate.

usage: python tests/oracle_compare.py [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = E.queries(), E.oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"spark error: {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        if name not in sql:
            results[name] = f"rows-only {len(srows)}"
            print(name, results[name], flush=True)
            continue
        try:
            rel = con.sql(sql[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"duckdb error: {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ok_cols = sorted(cols) == sorted(dcols)
        order = [dcols.index(c) for c in cols] if ok_cols else list(range(len(dcols)))
        drows = [tuple(r[i] for i in order) for r in drows]
        same = ok_cols and canon(srows) == canon(drows)
        results[name] = "match" if same else "MISMATCH"
        print(f"{name}: {results[name]} spark={len(srows)} duck={len(drows)} "
              f"cols_ok={ok_cols} {time.time() - t0:.1f}s", flush=True)
        if not same and verbose:
            print("  spark cols", cols, "\n  duck cols ", dcols)
            a, b = canon(srows), canon(drows)
            sa, sb = set(a), set(b)
            print("  only spark:", [r for r in a if r not in sb][:3])
            print("  only duck: ", [r for r in b if r not in sa][:3])
    return results


if __name__ == "__main__":
    from barforge.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, f"/root/testdata/sf{sf}", sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v != "match" and not v.startswith("rows-only")]
    print("SUMMARY", len(res) - len(bad), "ok /", len(res), "bad:", bad)
