"""Run a registered Spark query and its DuckDB oracle on the same folder and compare them.

Usable from pytest and as a script: ``python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return float(f"{f:.10g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, queries: dict, oracles: dict) -> dict:
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(oracles[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols), "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    out["values_match"] = out["cols_match"] and a == b
    if not out["values_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = o_cols
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from courtside.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(8)
    con = duck(sf_dir)
    queries, oracles = E.queries(), E.oracle_sql()
    names = argv[1:] or [n for n in queries if n in oracles]
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir, queries, oracles)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:600]}
        ok = r.get("values_match")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
