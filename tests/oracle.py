"""Rows of a query from Spark and of its oracle from DuckDB, in one comparable form."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
from transitloom.testviews import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def spark_rows(spark, name: str, sf_dir: str):
    df = entry.queries()[name](spark, sf_dir)
    return _sorted(df.columns, df.collect())


def oracle_rows(con, name: str):
    cursor = con.execute(entry.oracle_sql()[name])
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())
