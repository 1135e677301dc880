"""Run a query and its SQL check on the same files and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def _value(v):
    return round(v, 9) if isinstance(v, float) else v


def compare(con, df, sql: str) -> str:
    """Empty text if both sides agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = [tuple(r) for r in df.collect()]
    a, b = _normal(got, df.columns), _normal(expected, columns)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}; only spark {list(set(a) - set(b))[:3]}; only sql {list(set(b) - set(a))[:3]}"
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        return f"values differ: only spark {list(left)[:3]}; only sql {list(right)[:3]}"
    kinds_a = [type(v) for v in (a[0] if a else ())]
    kinds_b = [type(v) for v in (b[0] if b else ())]
    return "" if kinds_a == kinds_b else f"types {kinds_a} != {kinds_b}"
