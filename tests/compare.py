"""Spark result against DuckDB result, as the driver compares them: sorted, by column name."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_plain(row[n]) for n in names) for row in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return names, sorted(rows, key=repr)
