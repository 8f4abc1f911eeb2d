"""Run registered queries and their SQL on one scale and compare: python tests/oracle_check.py <folder> [names]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if v.__class__.__name__ == "Decimal":
        return repr(float(v))
    return None if v is None else f"{type(v).__name__}:{v}"


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty if equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    want_columns, want = [c[0] for c in cur.description], cur.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} against {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    left, right = normal(got, df.columns), normal(want, want_columns)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    from cutline.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    con = connect(folder)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        kind = "sql " if name in entry.oracle_sql() else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {kind} {name:32s} {time.time() - start:6.1f}s {problem}", flush=True)
