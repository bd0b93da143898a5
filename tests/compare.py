"""Compare a Spark result with its oracle SQL: names, types, rows and values."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def _types(table: pa.Table) -> dict[str, str]:
    kinds = {}
    for name in table.column_names:
        kind = str(table.schema.field(name).type)
        kinds[name] = "string" if kind in ("large_string", "string_view") else kind
    return kinds


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty when the two agree exactly, doubles included."""
    got = result.toArrow()
    want = connection.sql(sql).to_arrow_table()
    found = []
    if _types(got) != _types(want):
        found.append(f"schema {_types(got)} != {_types(want)}")
    if sorted(got.column_names) == sorted(want.column_names):
        mine, theirs = _rows(got), _rows(want)
        if len(mine) != len(theirs):
            found.append(f"{len(mine)} rows != {len(theirs)}")
        differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
        if differing:
            found.append(f"{len(differing)} rows differ, first {differing[0]}")
    return found
