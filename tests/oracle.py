"""Run registered queries beside their oracle SQL: ``python -m tests.oracle [folder] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str, function, sql: str | None):
    """(ok, message, seconds) of one query."""
    start = time.monotonic()
    df = function(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.monotonic() - start
    if sql is None:
        return True, f"{len(got[1])} rows, no oracle", seconds
    cursor = con.execute(sql)
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}", seconds
    if got[1] != want[1]:
        only_got = sorted(set(got[1]) - set(want[1]))[:3]
        only_want = sorted(set(want[1]) - set(got[1]))[:3]
        return False, f"rows {len(got[1])} != {len(want[1])}; spark {only_got} oracle {only_want}", seconds
    return True, f"{len(got[1])} rows", seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from cadenza.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session("8"), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name in names:
        try:
            ok, message, seconds = compare(spark, con, folder, name, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as e:
            ok, message, seconds = False, f"{type(e).__name__}: {str(e)[:700]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name} {seconds:.2f}s {message}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
