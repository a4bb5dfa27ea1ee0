"""Runs registered queries against their SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime) and value.tzinfo:
        value = value.astimezone(datetime.UTC).replace(tzinfo=None)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in data)


def differences(spark, connection, sf_dir, function, sql):
    result = function(spark, sf_dir)
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    expected = rows(names, relation.fetchall())
    if sorted(result.columns) != sorted(names):
        return [("columns", sorted(result.columns), sorted(names))]
    actual = rows(result.columns, result.collect())
    if actual == expected:
        return []
    extra = [r for r in actual if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(actual)][:3]
    return [("rows", len(actual), len(expected)), ("extra", extra), ("missing", missing)]
