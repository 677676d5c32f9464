"""Run registered Spark queries and their DuckDB oracles side by side; compare as multisets.

    python -m tests.oracle_check /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v) if not isinstance(v, (int, bool)) else v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, sf_dir: str, keys=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        sdf = qs[k](spark, sf_dir)
        s_cols, s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
        t1 = time.time()
        if k not in sqls:
            results[k] = ("no-oracle", sum(s_rows.values()))
            if verbose:
                print(f"{k:34s} rows={sum(s_rows.values()):7d} (no oracle) {t1 - t0:5.1f}s", flush=True)
            continue
        rel = con.sql(sqls[k])
        d_cols, d_rows = rows_of(rel.columns, rel.fetchall())
        ok = s_cols == d_cols and s_rows == d_rows
        results[k] = ("ok" if ok else "MISMATCH", sum(s_rows.values()), sum(d_rows.values()))
        if verbose:
            print(f"{k:34s} {'ok' if ok else 'MISMATCH':8s} spark={sum(s_rows.values()):7d} "
                  f"duck={sum(d_rows.values()):7d} {t1 - t0:5.1f}s", flush=True)
            if not ok:
                if s_cols != d_cols:
                    print("   cols spark", s_cols, "\n   cols duck ", d_cols)
                else:
                    only_s = list((s_rows - d_rows).elements())[:3]
                    only_d = list((d_rows - s_rows).elements())[:3]
                    print("   cols", s_cols)
                    print("   spark-only", only_s)
                    print("   duck-only ", only_d)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tallyspark.session import build_session
    spark = build_session("local[8]", 8)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("MISMATCHES:", bad)
