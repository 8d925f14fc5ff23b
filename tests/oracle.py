"""Compares a query with its SQL on DuckDB."""

from __future__ import annotations

import decimal
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*([plain(v) for v in table.column(n).to_pylist()] for n in names)), key=repr)


def same(spark, sf_dir: str, query, statement: str) -> None:
    ours, theirs = query(spark, sf_dir).toArrow(), connect(sf_dir).sql(statement).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert rows_of(ours) == rows_of(theirs)
