"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value)))
    return (3, str(value))


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    spark_rows = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    oracle_rows = canonical(names, answer.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(spark_rows) != len(oracle_rows):
        return f"rows {len(spark_rows)} != {len(oracle_rows)}"
    different = [(a, b) for a, b in zip(spark_rows, oracle_rows) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
