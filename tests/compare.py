"""Rows of a Spark query next to rows of its SQL, both as sorted text."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _text(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(connection, text):
    result = connection.execute(text)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
