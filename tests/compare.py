"""Compare a Spark result with a DuckDB result, independent of row and column order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), normalised(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normalised(df.columns, df.collect())
