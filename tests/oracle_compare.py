"""Run a registered query in Spark and its DuckDB statement; compare results.

Mirrors the driver's check: same column names, same row count and the same
multiset of rows (order-insensitive), with floats compared after rounding;
additionally each column must hold the same Python value type on both sides.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return ("f", round(v, 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    return ("s", str(v))


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def _types(columns, records):
    return {c: {type(r[i]).__name__ for r in records if r[i] is not None} for i, c in enumerate(columns)}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    out["values_match"] = out["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    # the same Python type per column on both sides (so even a hash of raw values agrees)
    out["types_match"] = out["columns_match"] and _types(s_cols, s_rows) == _types(d_cols, d_rows)
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
    elif not out["values_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["spark_extra"] = list((a - b).items())[:3]
        out["oracle_extra"] = list((b - a).items())[:3]
    out["ok"] = out["values_match"] and out["types_match"] and len(s_rows) == len(d_rows)
    return out


if __name__ == "__main__":
    import os
    import sys
    import time
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from patronage.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    con = duckdb_connection(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    names = sys.argv[1:] or [n for n in qs if n in sqls]
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(f"{'OK ' if r['ok'] else 'BAD'} {time.time() - t0:5.1f}s {r}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
