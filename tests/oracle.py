"""Compare a query's rows with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# DuckDB type names of Spark types.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types, row count and rows; empty when equal."""
    result = connection.execute(sql)
    their_types = {c[0]: str(c[1]) for c in result.description}
    our_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if our_types != their_types:
        found.append(f"schema {our_types} against {their_types}")
    if set(our_types) != set(their_types):
        return found
    names = sorted(our_types)
    positions = [list(their_types).index(n) for n in names]
    theirs = [tuple(_plain(r[i]) for i in positions) for r in result.fetchall()]
    ours = [tuple(_plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    ours.sort(key=_key)
    theirs.sort(key=_key)
    for a, b in zip(ours, theirs):
        if a != b:
            found.append(f"first differing row {names}: {str(a)[:600]} against {str(b)[:600]}")
            break
    return found
