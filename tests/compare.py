"""Spark results against DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations
""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.15g}")
    return value


def rows_of(records, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in records), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of([tuple(r) for r in df.collect()], df.columns)


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), rows_of(result.fetchall(), columns)
