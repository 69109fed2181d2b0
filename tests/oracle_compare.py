"""Run a named Spark query and its DuckDB oracle on the same parquet tables
and compare row count, column names and an order-insensitive value multiset.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare doubles bit for bit


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [columns[i] for i in order], out


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        res["status"] = "schema-mismatch"
        res["detail"] = {"spark_only": sorted(set(sc) - set(dc)), "oracle_only": sorted(set(dc) - set(sc))}
    elif len(sr) != len(dr):
        res["status"] = "count-mismatch"
    elif sr != dr:
        res["status"] = "value-mismatch"
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        res["detail"] = {"columns": sc, "first_diffs": diff}
    else:
        res["status"] = "match"
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from marketscope.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, sf_dir, name, qs[name], os_.get(name), con)
        except Exception as e:  # report and go on
            r = {"name": name, "status": "error", "detail": repr(e)[:400]}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
