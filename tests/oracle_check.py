"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if v is None:
        return "None"
    return str(v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = sorted(tuple(norm(r[i]) for i in order) for r in rows)
    return [names[i] for i in order], out


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return {"key": key, "rows": len(srows), "oracle": None, "sec": round(t1 - t0, 2)}
    res = con.execute(sql)
    dnames = [c[0] for c in res.description]
    drows = res.fetchall()
    sn, sc = canon(df.columns, srows)
    dn, dc = canon(dnames, drows)
    ok = sn == dn and sc == dc
    out = {"key": key, "rows": len(srows), "oracle_rows": len(drows), "match": ok, "sec": round(t1 - t0, 2)}
    if not ok:
        out["spark_cols"], out["oracle_cols"] = sn, dn
        diff_s = [r for r in sc if r not in set(dc)][:3]
        diff_d = [r for r in dc if r not in set(sc)][:3]
        out["spark_only"], out["oracle_only"] = diff_s, diff_d
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from ledgerline.session import get_session

    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], orc.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv)
