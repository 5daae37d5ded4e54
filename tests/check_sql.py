"""Runs registered queries and their SQL side by side and compares the rows.

    python tests/check_sql.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as registered
from corvane.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def shape(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, folder: str, name: str) -> str | None:
    """None when the query and its SQL agree, else the first difference."""
    df = registered.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {df.columns} / {columns}"
    want = shape(result.fetchall(), columns)
    got = shape(got, df.columns)
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for mine, other in zip(got, want):
        if repr(mine) != repr(other):
            return f"values {mine} / {other}"
    return None if got else "no rows"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    names = args.names or list(registered.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = differences(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001
            diff = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in registered.oracle_sql() else "rows"
        print(f"{'ok  ' if diff is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {diff or ''}"[:2000], flush=True)
        bad += diff is not None
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
