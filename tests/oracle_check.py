"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle on the same parquet.

Compares row count, column names and an order-insensitive hash of the rows (columns sorted by
name). Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        v = round(v, 6)
        return repr(0.0 if v == 0 else v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return repr(float(v)) if False else str(v)
    if v is None:
        return "None"
    try:
        from decimal import Decimal
        if isinstance(v, Decimal):
            return _norm(float(v))
    except Exception:
        pass
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    hs = sorted(hashlib.md5("|".join(_norm(r[i]) for i in order).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:28s} SPARK_ERROR {str(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS_ONLY", len(rows))
            if verbose:
                print(f"{name:28s} rows-only  n={len(rows)}  {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(sqls[name])
            ocols = [d[0] for d in rel.description]
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:28s} SQL_ERROR {str(e)[:400]}", flush=True)
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        ok_n = len(rows) == len(orows)
        ok_h = ok_cols and digest(cols, rows) == digest(ocols, orows)
        status = "OK" if (ok_cols and ok_n and ok_h) else "MISMATCH"
        results[name] = (status, len(rows), len(orows), ok_cols, ok_h)
        if verbose:
            extra = "" if ok_cols else f" cols spark={sorted(cols)} sql={sorted(ocols)}"
            print(f"{name:28s} {status:8s} n={len(rows)}/{len(orows)} hash={ok_h}{extra}  {ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from baflow.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    res = check(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")]
    print("FAILED:", bad)
