"""Compares queries with their SQL: same columns, same rows whatever their order."""

from __future__ import annotations

import math
import pathlib
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{pathlib.Path(sf_dir) / name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.9g}") if not value.is_integer() else (1, str(int(value)))
    return (1, str(value))


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(_plain(r[i]) for i in at) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """``None`` or what differs, and the seconds both took."""
    start = time.time()
    df = query(spark, str(sf_dir))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    middle = time.time()
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    took = (middle - start, time.time() - middle)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", took
    if got[1] != want[1]:
        a, b = [r for r in got[1] if r not in set(want[1])], [r for r in want[1] if r not in set(got[1])]
        return f"{len(got[1])} and {len(want[1])} rows; only Spark {a[:3]}; only SQL {b[:3]}", took
    return None, took
