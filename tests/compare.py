"""Runs catalog queries next to their SQL and compares the rows."""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from openroles.catalog.views import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return f"{type(value).__name__[:3]}:{value}" if isinstance(value, bool) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(frame, con, sql: str) -> str | None:
    """What differs, or None."""
    got = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    a, b = rows_of(frame.columns, got), rows_of(names, want)
    if a == b:
        return None if a else "both sides are empty"
    only_a = sorted(set(a) - set(b))[:3]
    only_b = sorted(set(b) - set(a))[:3]
    return f"{len(a)} rows != {len(b)} rows\n   spark {only_a}\n   sql   {only_b}"
