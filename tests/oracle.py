"""Runs a registered query in Spark and its SQL in DuckDB and compares the results."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(v: object) -> str:
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def canonical(v: object) -> object:
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9) + 0.0
    if isinstance(v, decimal.Decimal):
        return "decimal " + str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canonical(x) for x in v)
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple((_kind(r[i]), canonical(r[i])) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    rel = con.execute(sql)
    sql_columns = [d[0] for d in rel.description]
    expected = rel.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_columns)}"
    a, b = rows_of(spark_df.columns, got), rows_of(sql_columns, expected)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diff = [(n, p, q) for n, p, q in zip(sorted(sql_columns), x, y) if p != q]
            return f"values differ: {diff[:4]}"
    return None if a else "empty"
