"""Run registered queries against their DuckDB oracles (same checks as the driver:
row count, column names, order-insensitive value hash)."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    t1 = time.time()
    res = con.sql(sql)
    ocols = [c for c in res.columns]
    orows = res.fetchall()
    ok_cols = sorted(cols) == sorted(ocols)
    ok_n = len(rows) == len(orows)
    ok_h = ok_cols and digest(cols, rows) == digest(ocols, orows)
    return dict(name=name, rows=len(rows), oracle_rows=len(orows), cols_ok=ok_cols, count_ok=ok_n,
                hash_ok=ok_h, sec=round(t1 - t0, 2), cols=cols, ocols=ocols)


if __name__ == "__main__":
    import importlib.util
    import os
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("__spark_entry__", os.path.join(repo, "__spark_entry__.py"))
    E = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(E)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:] or None
    if os.environ.get("PLAIN_SESSION"):
        # what a caller with its own default session sees
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from sensorflow.session import build_session
        spark = build_session()
    con = duck(sf)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for k in sorted(qs):
        if only and k not in only:
            continue
        if k not in os_:
            df = qs[k](spark, sf)
            print(f"ROWS-ONLY {k}: {df.count()} rows", flush=True)
            continue
        try:
            r = compare(spark, k, qs[k], os_[k], sf, con)
        except Exception as e:  # noqa
            bad += 1
            print(f"ERROR {k}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        ok = r["cols_ok"] and r["count_ok"] and r["hash_ok"]
        bad += not ok
        print(("OK   " if ok else "FAIL ") + f"{k}: rows={r['rows']}/{r['oracle_rows']} cols={r['cols_ok']} "
              f"hash={r['hash_ok']} {r['sec']}s" + ("" if r["cols_ok"] else f" {r['cols']} vs {r['ocols']}"),
              flush=True)
    print("FAILED", bad)
