"""Runs a query and its SQL side by side and compares rows without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    out = duckdb.connect()
    out.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        p = Path(sf_dir, f"{name}.parquet")
        if p.exists():
            out.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return out


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(df, sql: str, sf_dir: str) -> tuple[int, list]:
    """(number of rows, differing rows); fails on differing columns."""
    got = rows_of(df.columns, df.collect())
    found = connection(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    return len(got), [(a, b) for a, b in zip(got, want, strict=False) if a != b][:3] + ([("rows", len(got), len(want))] if len(got) != len(want) else [])
