"""Runs registered queries beside their SQL in DuckDB and compares the values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, (dt.datetime, dt.date)):
        return f"{type(value).__name__}:{value.isoformat()}"
    return None if value is None else f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(row[i])) for i in order) for row in rows)


def compare(spark_df, con, sql):
    """None when both sides agree, otherwise what differs."""
    got = rows_of(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}\n{g}\n{w}"
    return None
