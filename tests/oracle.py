"""Runs a registered query in Spark and its SQL in DuckDB and compares all rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: tuple((v is None, str(v)) for v in row))


def difference(spark, connection, sf_dir: str, build, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = build(spark, sf_dir)
    got_names = df.columns
    got = sorted_rows(got_names, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    want_names = [column[0] for column in cursor.description]
    want = sorted_rows(want_names, cursor.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if got == want:
        return None
    only_got = [row for row in got if row not in set(want)][:3]
    only_want = [row for row in want if row not in set(got)][:3]
    return f"{len(got)} rows != {len(want)} rows; spark only {only_got}; sql only {only_want}"
