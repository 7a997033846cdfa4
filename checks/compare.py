"""Run registered queries and their SQL twins side by side.

``python -m checks.compare [folder] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import oracle, registry
from tarmac.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "" if value is None else f"{type(value).__name__}:{value}"


def sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(str(plain(row[at])) for at in order) for row in rows)


def differences(spark, connection, folder: str, name: str, sql: str | None) -> tuple[str, float, int]:
    started = time.time()
    frame = registry.QUERIES[name](spark, folder)
    rows = [tuple(row) for row in frame.collect()]
    seconds = time.time() - started
    if sql is None:
        return ("rows only" if rows else "NO ROWS"), seconds, len(rows)
    relation = connection.execute(sql)
    expected_names = [column[0] for column in relation.description]
    expected = relation.fetchall()
    if sorted(frame.columns) != sorted(expected_names):
        return f"COLUMNS {sorted(set(frame.columns) ^ set(expected_names))}", seconds, len(rows)
    got, want = sorted_rows(frame.columns, rows), sorted_rows(expected_names, expected)
    if got == want:
        return ("ok" if rows else "ok but EMPTY"), seconds, len(rows)
    first = next(((g, w) for g, w in zip(got, want) if g != w), "")
    return f"DIFFERENT {len(got)} / {len(want)} rows; first: {first}", seconds, len(rows)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, texts, bad = duck(folder), oracle.oracle_sql(), 0
    for name in names or registry.QUERIES:
        try:
            verdict, seconds, count = differences(spark, connection, folder, name, texts.get(name))
        except Exception as problem:  # noqa: BLE001 - shown and counted
            verdict, seconds, count = f"FAILED {type(problem).__name__}: {str(problem)[:600]}", 0.0, 0
        bad += not verdict.startswith(("ok", "rows only")) or "EMPTY" in verdict
        print(f"{name:45s} {seconds:6.2f}s {count:8d}  {verdict}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
