"""Order-insensitive comparison of a Spark result with DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import math
import pathlib

import duckdb

_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, types, row count and all values agree."""
    found = []
    result = con.sql(sql)
    names = {c: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
             for c, f in zip(spark_df.columns, spark_df.schema)}
    wanted = dict(zip(result.columns, map(str, result.types)))
    if names != wanted:
        odd = {k: (names.get(k), wanted.get(k)) for k in names.keys() | wanted.keys()
               if names.get(k) != wanted.get(k)}
        found.append(f"schema {odd}")
    if set(names) != set(wanted):
        return found
    left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = _rows(result.columns, result.fetchall())
    if len(left) != len(right):
        found.append(f"rows {len(left)} vs {len(right)}")
    if left != right:
        in_left, in_right = set(left), set(right)
        only_l = [r for r in left if r not in in_right][:2]
        only_r = [r for r in right if r not in in_left][:2]
        found.append(f"values {sorted(names)}\n   spark {only_l}\n   duck  {only_r}")
    if not left:
        found.append("EMPTY")
    return found
