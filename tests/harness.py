"""Compares a registered query with its DuckDB oracle, value by value."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(row count, first difference or None)."""
    got_columns, got = _rows(df.columns, [tuple(x) for x in df.collect()])
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"{a} != {b}"
    return len(got), None
