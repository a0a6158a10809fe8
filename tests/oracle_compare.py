"""Run registered queries against their DuckDB oracle and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), and prints differing rows on mismatch.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        sdf = qs[key](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        t_spark = time.time() - t0
        res = {"rows": len(s_rows), "spark_sec": round(t_spark, 2)}
        if key not in sqls:
            res["status"] = "rows-only"
            results[key] = res
            if verbose:
                print(f"{key:28s} rows-only rows={len(s_rows)} {t_spark:.1f}s")
            continue
        cur = con.execute(sqls[key])
        d_cols = [d[0] for d in cur.description]
        d_rows = cur.fetchall()
        sc, sn = normalise(s_cols, s_rows)
        dc, dn = normalise(d_cols, d_rows)
        ok = sc == dc and len(sn) == len(dn) and digest(sn) == digest(dn)
        res.update(status="match" if ok else "MISMATCH", oracle_rows=len(d_rows))
        results[key] = res
        if verbose:
            print(f"{key:28s} {res['status']:8s} spark={len(s_rows)} duck={len(d_rows)} {t_spark:.1f}s")
            if not ok:
                if sc != dc:
                    print("   columns spark:", sc, "\n   columns duck: ", dc)
                ss, ds = set(sn), set(dn)
                print("   only spark:", sorted(ss - ds, key=repr)[:3])
                print("   only duck: ", sorted(ds - ss, key=repr)[:3])
    return results


def main():
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, keys)
    bad = [k for k, v in res.items() if v["status"] == "MISMATCH"]
    print("mismatches:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
