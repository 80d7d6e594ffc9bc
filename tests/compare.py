"""Compare a registered query with its oracle SQL, values and row counts."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, decimal.Decimal, float)):
        number = float(value)
        return "nan" if math.isnan(number) else number
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def differences(spark, con, folder, function, sql) -> str | None:
    """None when both sides agree, else a short description."""
    df = function(spark, folder)
    ours, our_names = as_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs, their_names = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, e.g. {str(wrong[0])[:600]}"
    return None
