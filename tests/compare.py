"""Compare a Spark result with its SQL twin: columns, row count and order-free values."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from tidemark.tables import TABLE_NAMES


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return df.columns, [tuple(row) for row in df.collect()]


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return [item[0] for item in cursor.description], cursor.fetchall()


def difference(spark_result, duck_result) -> str:
    """Empty when equal, otherwise one line saying what differs."""
    spark_columns, left = spark_result
    duck_columns, right = duck_result
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(spark_columns)} != {sorted(duck_columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    left, right = sorted_rows(spark_columns, left), sorted_rows(duck_columns, right)
    for a, b in zip(left, right):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return ""
