"""Compare queries with their SQL twins on DuckDB."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{base}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0) if v != int(v) or abs(v) > 1e15 else repr(float(v) + 0.0)
    return repr(v)


def normalize(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows])


def compare(df, con, sql):
    """None when equal, else a description of the first difference."""
    cur = con.execute(sql)
    want_cols, want = normalize([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = normalize(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        only = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"rows {len(got)} != {len(want)}; {only}"
    for g, w in zip(got, want):
        if g != w:
            n = sum(1 for a, b in zip(got, want) if a != b)
            return f"{n} rows differ, cols {got_cols}: {g} != {w}"
    return None
