"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py SF_DIR [name ...]
Prints one line per query: rows, match of schema names and sorted values.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["pages", "documents", "conversations", "benchmark", "labels", "embeddings"]


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def run(spark, sf, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    qs, os_ = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t0
        if name not in os_:
            results[name] = ("rows-only", len(rows))
            if verbose:
                print(f"{name:32s} rows={len(rows):7d} no-oracle {dt:6.1f}s", flush=True)
            continue
        rel = con.sql(os_[name])
        ocols = rel.columns
        orows = rel.fetchall()
        same_cols = sorted(cols) == sorted(ocols)
        same = same_cols and canon(rows, cols) == canon(orows, ocols)
        results[name] = (same, len(rows), len(orows))
        if verbose:
            print(f"{name:32s} rows={len(rows):7d} oracle={len(orows):7d} cols={'ok' if same_cols else 'DIFF'} "
                  f"values={'ok' if same else 'DIFF'} {dt:6.1f}s", flush=True)
            if not same and same_cols:
                a, b = canon(rows, cols), canon(orows, ocols)
                sa, sb = set(a), set(b)
                print("   spark-only:", list(sa - sb)[:2])
                print("   oracle-only:", list(sb - sa)[:2])
            elif not same_cols:
                print("   spark cols:", cols, " oracle cols:", ocols)
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pagelens.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    run(spark, sys.argv[1], sys.argv[2:] or None)
