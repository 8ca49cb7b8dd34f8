"""Order-independent comparison of a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
    "DATE": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every parquet file of the folder as a view."""
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted_rows(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and all rows agree."""
    result = con.execute(sql)
    expected_types = {
        c[0]: TYPE_NAMES.get(str(c[1]), str(c[1]).lower()) for c in result.description
    }
    expected = _sorted_rows(result.fetchall(), list(expected_types))
    actual_types = {name: kind.replace("_ntz", "") for name, kind in df.dtypes}
    if sorted(expected_types) != sorted(actual_types):
        return [f"columns {sorted(actual_types)} instead of {sorted(expected_types)}"]
    found = [
        f"type of {name}: {kind} instead of {expected_types[name]}"
        for name, kind in actual_types.items()
        if kind != expected_types[name]
    ]
    actual = _sorted_rows(df.collect(), df.columns)
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} instead of {wrong[0][1]}")
    return found
