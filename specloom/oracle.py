"""Compare a registered query with its SQL, for tests and local checks."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

from specloom.plans.registry import TABLES

# Type names that count as the same.
_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _table(columns: list[str], rows: list) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, row count, values.  Empty when equal."""
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    expected_columns, expected = _table([d[0] for d in described], cursor.fetchall())
    columns, rows = _table(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    types = {name: kind for name, kind in described}
    for name, kind in df.dtypes:
        if _SAME.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    wrong = sorted(set(rows) ^ set(expected))
    if rows != expected:
        found.append(f"values differ in {len(wrong)} rows, e.g. {wrong[:6]}")
    return found
