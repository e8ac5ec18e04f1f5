"""Order-insensitive comparison of a Spark result with its SQL equivalent."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else ("float", repr(value + 0.0))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise a description."""
    columns, mine = bag(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    expected_columns, expected = bag([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if mine != expected:
        extra, lacking = list((mine - expected).items())[:3], list((expected - mine).items())[:3]
        return f"rows {mine.total()} / {expected.total()}; only here {extra}; only there {lacking}"
    return None
