"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
from decimal import Decimal

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = path.rsplit("/", 1)[-1].removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree exactly, else a description of the first disagreement."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    actual = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    for a, e in zip(actual, expected):
        for name, x, y in zip(sorted(names), a, e):
            if x != y or type(x) is not type(y):
                return f"{name}: {x!r} vs {y!r} in {a} / {e}"
            if isinstance(x, float) and math.isnan(x):
                return f"{name} is NaN"
    return None
