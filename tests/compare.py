"""Side-by-side check of registered queries against their SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_df, connection, sql: str) -> list[str]:
    found = []
    relation = connection.sql(sql)
    expected = rows_of(relation.columns, relation.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if sorted(relation.columns) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}")
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    for ours, theirs in zip(actual, expected, strict=False):
        if ours != theirs:
            found.append(f"first difference {ours} != {theirs}")
            break
        if [type(v) for v in ours] != [type(v) for v in theirs]:
            found.append(f"types {ours} != {theirs}")
            break
    return found
