"""Spark result against DuckDB result: same columns, types and rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "\0null" if value is None else str(value)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def _kind(dtype: pa.DataType) -> str:
    if pa.types.is_large_string(dtype):
        return "string"
    return str(dtype).replace("timestamp[us, tz=UTC]", "timestamp[us]")


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    found = []
    names = sorted(spark_table.column_names)
    if names != sorted(sql_table.column_names):
        return [f"columns {names} != {sorted(sql_table.column_names)}"]
    for n in names:
        ours, theirs = _kind(spark_table.schema.field(n).type), _kind(sql_table.schema.field(n).type)
        if ours != theirs:
            found.append(f"type of {n}: {ours} != {theirs}")
    if spark_table.num_rows != sql_table.num_rows:
        found.append(f"rows {spark_table.num_rows} != {sql_table.num_rows}")
    ours, theirs = _rows(spark_table, names), _rows(sql_table, names)
    if ours != theirs:
        only = sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]
        found.append(f"values {names}: only Spark {only[0]}; only SQL {only[1]}")
    return found
