"""Order-free comparison of a Spark result with the DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def canonical(columns, rows):
    """Rows as text, columns by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def duck_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
