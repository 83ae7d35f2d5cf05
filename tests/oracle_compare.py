"""Row-for-row comparison of a Spark result with a DuckDB query on the same tables."""

from __future__ import annotations

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(df):
    return _canonical(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(con, sql):
    result = con.execute(sql)
    return _canonical([d[0] for d in result.description], result.fetchall())
