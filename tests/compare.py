"""Run registered queries in Spark and DuckDB and compare the rows as bags."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def spark_rows(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())


def difference(df, connection, sql: str) -> str | None:
    """None if equal, else a description."""
    names, expected = duck_rows(connection, sql)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    actual = spark_rows(df)
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
            f"missing {list(missing)[:3]}, unexpected {list(extra)[:3]}")
