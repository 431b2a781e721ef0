"""Compares the registered queries with their oracle SQL on one data folder.

Usage: python tests/compare.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[str], list[tuple]]:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    return names, kinds, cursor.fetchall()


def normal(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, name: str, folder: str) -> dict:
    import __spark_entry__ as entry

    started = time.time()
    df = entry.queries()[name](spark, folder)
    rows = [tuple(row) for row in df.collect()]
    spark_sec, started = time.time() - started, time.time()
    names, kinds, expected = oracle_rows(entry.oracle_sql()[name], folder)
    got, want = normal(df.columns, rows), normal(names, expected)
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    return {
        "ok": sorted(df.columns) == sorted(names) and len(got) == len(want) and not differing,
        "rows": (len(got), len(want)),
        "types": ([t for _, t in df.dtypes], kinds),
        "sec": (round(spark_sec, 2), round(time.time() - started, 2)),
        "sample": differing[:2],
    }


if __name__ == "__main__":
    from glyphmill.session import build_session
    import __spark_entry__ as entry

    session = build_session("compare", 8)
    bad = []
    for query in sys.argv[2:] or sorted(entry.queries()):
        try:
            result = compare(session, query, sys.argv[1])
        except Exception as error:  # one broken query must not hide the others
            result = {"ok": False, "error": str(error)[:1500]}
        if not result["ok"]:
            bad.append(query)
        print(query, result, flush=True)
    print("differing:", bad)
