"""Run queries() against oracle_sql() the way the driver does: row count,
column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sc, sr = canon(srows, scols)
    dc, dr = canon(drows, dcols)
    ok = sc == dc and sr == dr
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"cols spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            detail = f"rows spark={len(sr)} duck={len(dr)}"
        else:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            detail = f"first diffs {diff}"
    print(f"{'OK  ' if ok else 'FAIL'} {name:28s} rows={len(srows):8d} spark={t1 - t0:6.2f}s duck={t2 - t1:6.2f}s {detail}",
          flush=True)
    return ok


def main():
    from __spark_entry__ import oracle_sql, queries
    from starweave.session import local_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    names = args or list(qs)
    bad = []
    for n in names:
        if n not in os_:
            df = qs[n](spark, sf_dir)
            print(f"ROWS {n:28s} rows={df.count():8d} (no oracle)")
            continue
        try:
            if not compare(spark, con, n, qs[n], os_[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and go on
            print(f"ERR  {n}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("failed:", bad)


if __name__ == "__main__":
    main()
