"""Run registered queries in Spark and DuckDB and compare the rows, regardless of order."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        f = float(value)
        if math.isnan(f):
            return "nan"
        return repr(f + 0.0)
    return str(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """(equal, message)"""
    start = time.time()
    df = query(spark, folder)
    left = [tuple(r) for r in df.collect()]
    spark_sec = time.time() - start
    if sql is None:
        return bool(left), f"rows={len(left)} spark={spark_sec:.1f}s (no SQL)"
    start = time.time()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    right = cur.fetchall()
    duck_sec = time.time() - start
    note = f"rows={len(left)}/{len(right)} spark={spark_sec:.1f}s duck={duck_sec:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"{note} columns differ: {sorted(set(df.columns) ^ set(names))}"
    a, b = normalise(df.columns, left), normalise(names, right)
    if a == b:
        return True, note
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return False, f"{note} differ {len(only_a)}/{len(only_b)}: {only_a[:2]} <> {only_b[:2]}"


def main(names: list[str], folder: str = "/root/testdata/sf0.01") -> int:
    from checks.registry import QUERIES
    from demandspark.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    con, bad = connect(folder), 0
    for name, (query, sql) in QUERIES.items():
        if names and not any(n in name for n in names):
            continue
        try:
            equal, note = compare(spark, con, folder, query, sql)
        except Exception as e:  # report and go on with the next query
            equal, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not equal
        print("ok  " if equal else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
