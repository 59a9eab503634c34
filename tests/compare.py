"""Comparison of a Spark result with a DuckDB result as sorted rows of exact values."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _key(value):
    return (value is None, type(value).__name__ if not isinstance(value, (int, float)) else "n", value if value is not None else 0)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(row[c] for c in columns) for row in df.collect()), key=lambda r: [_key(v) for v in r])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=lambda r: [_key(v) for v in r])


def differences(left, right, limit=5):
    """Readable differences; values must be equal, floats included."""
    (left_columns, left_rows), (right_columns, right_rows) = left, right
    if left_columns != right_columns:
        return [f"columns {left_columns} != {right_columns}"]
    if len(left_rows) != len(right_rows):
        return [f"rows {len(left_rows)} != {len(right_rows)}"]
    found = []
    for a, b in zip(left_rows, right_rows):
        same = all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))
        if not same:
            found.append(f"{a} != {b}")
    return found[:limit]
