"""Comparison of a Spark result with the SQL engine's rows, values and order of columns aside."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for python, name in ((int, "int"), (float, "float"), (Decimal, "decimal"), (str, "str")):
        if isinstance(value, python):
            return name
    if isinstance(value, dt.datetime):
        return "timestamp"
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    typed = (tuple((columns[i], kind(row[i]), row[i]) for i in order) for row in rows)
    return sorted(typed, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return rows_of(columns, result.fetchall())
