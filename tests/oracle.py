"""Comparison of a query's rows with its SQL's, as multisets with columns by name."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if the two agree."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = connection(sf_dir).sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    want = rows_of(rel.columns, rel.fetchall())
    if got == want:
        return ""
    odd = [(a, b) for a, b in zip(got, want, strict=False) if a != b][:3]
    return f"{len(got)} and {len(want)} rows; {odd}"
