"""Compare query results with SQL run by DuckDB, rows as a multiset of values by column name."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def value_key(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def as_rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(value_key(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> tuple[int, list, list]:
    """Row count, rows only Spark has, rows only SQL has."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = as_rows(names, answer.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    return sum(got.values()), list((got - expected).items()), list((expected - got).items())
