"""Compares a query with its SQL: row count, column names, and the rows themselves without regard to order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def compare(df, con, text: str) -> str | None:
    """None when equal, else what differs first."""
    got = df.collect()
    result = con.execute(text)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    want = result.fetchall()
    left, right = rows(df.columns, got), rows(columns, want)
    if left != right:
        more, less = list((left - right).items())[:3], list((right - left).items())[:3]
        return f"{len(got)} rows against {len(want)}; only here {more}; only there {less}"
    return None
