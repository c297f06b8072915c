"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Mirrors the driver's check: same column names (sorted), same row count and
the same multiset of rows.  Usage: python -m tests.oracle_compare [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')"
        )
    return con


EXACT = bool(os.environ.get("ORACLE_EXACT"))


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else round(v, 9) + 0.0
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def compare(spark, sf_dir, key, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_names = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        res["status"] = f"COLUMNS {sorted(s_names)} vs {sorted(d_names)}"
        return res
    a, b = Counter(rows_of(s_names, s_rows)), Counter(rows_of(d_names, d_rows))
    if a == b:
        res["status"] = "ok"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res["status"] = "MISMATCH"
        res["cols"] = sorted(s_names)
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from riskhouse.session import build_session

    spark = build_session()
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], oracle.get(k), con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} passed, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
