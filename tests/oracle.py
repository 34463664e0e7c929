"""Runs queries and their SQL on the same tables and compares all rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def plain(v: object) -> object:
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(f"{float(v):.9g}")
    return v


def rows_of(names: list[str], rows: list) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def difference(spark, name: str, query, sql: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = connect(sf_dir).execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if mine != theirs:
        a, b = set(mine), set(theirs)
        return f"{len(mine)} and {len(theirs)} rows; only here {sorted(a - b)[:4]}, only there {sorted(b - a)[:4]}"
    return None
