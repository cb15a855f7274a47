"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: same row count, same column names (sorted), and
the same multiset of rows.  Usable from tests and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name, sf_dir, con=None):
    from tidemark.registry import ORACLE, QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if name not in ORACLE:
        return {"name": name, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "spark_s": round(t1 - t0, 2)}
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["spark_only"] = diff_a
        out["oracle_only"] = diff_b
        out["spark_cols"] = scols
        out["oracle_cols"] = dcols
    out["ok"] = out["cols_match"] and out["values_match"] and len(srows) == len(drows)
    return out


if __name__ == "__main__":
    from tidemark.registry import QUERIES
    from tidemark.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": str(e)[:600]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad, "of", len(names))
