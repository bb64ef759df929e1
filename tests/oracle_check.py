"""Spark-vs-DuckDB comparison of registered queries (row count, column
names, order-insensitive values).

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records) -> Counter:
    return Counter(tuple(_norm(x) for x in r) for r in records)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None):
    t = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(r[c] for c in sorted(cols)) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return {"name": name, "rows": len(srows), "spark_sec": round(ts, 2), "oracle": None}
    t = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drecs = res.fetchall()
    td = time.time() - t
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(r[i] for i in order) for r in drecs]
    ok_cols = sorted(cols) == sorted(dcols)
    a, b = rows_of(srows), rows_of(drows)
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "cols_match": ok_cols,
           "values_match": a == b, "spark_sec": round(ts, 2), "duck_sec": round(td, 2)}
    if not ok_cols:
        out["spark_cols"] = sorted(cols)
        out["duck_cols"] = sorted(dcols)
    if a != b:
        out["only_spark"] = list((a - b).items())[:2]
        out["only_duck"] = list((b - a).items())[:2]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as e
    from docsmith.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, ss = e.queries(), e.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], ss.get(name))
        except Exception as ex:  # report and go on
            r = {"name": name, "error": repr(ex)[:500]}
        ok = r.get("oracle") is None and "error" not in r or (r.get("values_match") and r.get("cols_match"))
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
