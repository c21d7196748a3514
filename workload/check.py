"""Compare every query with its SQL: ``python -m workload.check [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from ledgerfold.session import build
from workload.queries import QUERIES
from workload.sql import SQL


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    return value


def _sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def differs(spark, database, sf_dir: str, name: str) -> str:
    """What is wrong with a query's result, or an empty text."""
    got = QUERIES[name](spark, sf_dir)
    columns, rows = _sorted_rows(got.columns, got.collect())
    if name not in SQL:
        return "" if rows else "no rows"
    want = database.execute(SQL[name])
    names = [d[0] for d in want.description]
    want_columns, want_rows = _sorted_rows(names, want.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows != {len(want_rows)}"
    for a, b in zip(rows, want_rows):
        if a != b:
            return f"{a} != {b}"
    return "" if rows else "no rows on either side"


def connect(sf_dir: str):
    database = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return database


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    database = connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        started = time.time()
        try:
            wrong = differs(spark, database, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(wrong)
        print(f"{name:36} {time.time() - started:6.2f}s {wrong or 'ok'}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(QUERIES) - set(SQL))}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
