"""Runs a query and its SQL partner over the same folder and compares schema, rows and values."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def as_bag(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# How the two engines name what is the same type.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else a short description."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    theirs_names, theirs = as_bag([d[0] for d in result.description], result.fetchall())
    ours_names, ours = as_bag(df.columns, df.collect())
    if ours_names != theirs_names:
        return f"columns {ours_names} against {theirs_names}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours "
            f"{list((ours - theirs).items())[:2]}; only theirs {list((theirs - ours).items())[:2]}"
        )
    types = {n: (SAME_TYPE.get(t, t), theirs_types[n]) for n, t in df.dtypes}
    odd = {n: pair for n, pair in types.items() if pair[0] != pair[1]}
    return f"types {odd}" if odd else None
