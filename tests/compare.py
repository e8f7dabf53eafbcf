"""Rows of a Spark query beside rows of its SQL, whatever their order."""

from __future__ import annotations

import duckdb

TABLES = ["nation", "customer", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([names[i] for i in order],) + tuple(repr(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duckdb_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return rows_of(names, result.fetchall())
