"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name,name,...]
Columns are compared by name; rows as an order-insensitive multiset.
"""

from __future__ import annotations

import collections
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(repr(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in records), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sc, scols = rows_of(sdf.columns, srows)
    dc, dcols_s = rows_of(dcols, drows)
    stypes = dict(sdf.dtypes)
    ok = scols == dcols_s and sc == dc
    msg = f"{name:18s} {'OK ' if ok else 'BAD'} spark={len(srows)} duck={len(drows)} ({t1 - t0:.1f}s / {t2 - t1:.1f}s)"
    if scols != dcols_s:
        msg += f"\n   cols spark={scols}\n   cols duck ={dcols_s}"
    elif sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        msg += f"\n   cols={scols}\n   spark-only={str(only_s)[:600]}\n   duck-only ={str(only_d)[:600]}"
    tmsg = " ".join(f"{c}:{stypes[c]}/{[d[1] for d in res.description if d[0] == c][0]}" for c in scols) \
        if scols == dcols_s else ""
    return ok, msg, tmsg


def main():
    sys.path.insert(0, "/root/repo")
    from lexcurate.session import local_session
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    qs, sqls = E.queries(), E.oracle_sql()
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else [n for n in qs if n in sqls]
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg, tmsg = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, tmsg = False, f"{n:18s} ERR {type(e).__name__}: {str(e)[:800]}", ""
        bad += not ok
        print(msg, flush=True)
        if tmsg:
            print("   types " + tmsg, flush=True)
    print(f"{len(names) - bad}/{len(names)} match", flush=True)


if __name__ == "__main__":
    main()
