"""Spark query vs DuckDB oracle: row count, column names, and the multiset
of rows (order-insensitive), the way the correctness gate compares them.

Run as a script for a report: ``python tests/oracle_compare.py SF_DIR [name...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return ("s", str(v))


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = df.collect()
    t1 = time.time()
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    t2 = time.time()
    cols_ok = sorted(s_cols) == sorted(o_cols)
    values_ok = cols_ok and _rows(s_cols, s_rows) == _rows(o_cols, o_rows)
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns_ok": cols_ok,
        "values_ok": values_ok,
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    if not values_ok:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = o_cols
        if cols_ok:
            a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
            out["only_spark"] = list((a - b).items())[:3]
            out["only_oracle"] = list((b - a).items())[:3]
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(queries)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n, queries[n], oracle[n])
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_ok")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
