"""Comparing a Spark result with DuckDB over the same parquet files, value by value."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, Decimal):
        return ("n", value.normalize() if value else Decimal(0))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return ("n", Decimal(value).normalize() if value else Decimal(0))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def duck_rows(sql: str, folder: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def difference(df, sql: str, folder: str) -> str:
    """Empty when both sides agree on columns and rows, else a short account."""
    s_names, s_rows = spark_rows(df)
    d_names, d_rows = duck_rows(sql, folder)
    if s_names != d_names:
        return f"columns {s_names} vs {d_names}"
    if s_rows == d_rows:
        return ""
    extra, missing = s_rows - d_rows, d_rows - s_rows
    return (
        f"rows {s_rows.total()} vs {d_rows.total()}; only spark {extra.total()}, only duckdb {missing.total()}\n"
        f"  spark  {sorted(extra, key=str)[:2]}\n  duckdb {sorted(missing, key=str)[:2]}"
    )
