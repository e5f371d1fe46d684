"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_by_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as sorted tuples of text, columns in order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("<null>" if r[i] is None else str(r[i]) for i in order) for r in rows)


def spark_rows(df: DataFrame) -> list[tuple]:
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    result = con.sql(sql)
    return rows_by_name(result.columns, result.fetchall())
