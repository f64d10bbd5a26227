"""Runs queries and their SQL twins and compares row counts, column types and values."""

from __future__ import annotations

import decimal
import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, connection, sql: str) -> list[str]:
    columns, ours = _rows(spark_df.columns, spark_df.collect())
    result = connection.execute(sql)
    described = {entry[0]: str(entry[1]) for entry in result.description}
    expected_columns, theirs = _rows(list(described), result.fetchall())
    found = []
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    for name, kind in spark_df.dtypes:
        expected = _KINDS.get(kind, kind.upper())
        if described[name].replace(" ", "") != expected:
            found.append(f"type of {name}: {kind} != {described[name]}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {unequal[0]}")
    return found


def run(spark, queries, oracles, sf_dir, names=None):
    connection = connect(sf_dir)
    for name in names or queries:
        started = time.monotonic()
        df = queries[name](spark, sf_dir)
        if name in oracles:
            found = differences(df, connection, oracles[name])
        else:
            found = [] if df.collect() else ["no rows"]
        yield name, found, time.monotonic() - started
