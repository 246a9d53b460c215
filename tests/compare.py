"""Compare registered queries with their oracle SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    star = "/*.parquet" if os.path.isdir(f"{sf_dir}/region.parquet") else ""
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet{star}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)) if v is None else "", repr(v)) for v in row))


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    want = connection.execute(sql)
    want_columns = [d[0] for d in want.description]
    want_rows = _sorted_rows(want_columns, want.fetchall())
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    have_rows = _sorted_rows(df.columns, df.collect())
    if len(have_rows) != len(want_rows):
        return f"{len(have_rows)} rows, expected {len(want_rows)}"
    for have, expected in zip(have_rows, want_rows):
        if have != expected:
            return f"{have} != {expected}"
    return None
