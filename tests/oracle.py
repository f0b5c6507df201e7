"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck_rows(sf_dir: str, sql: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')"
        )
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return columns, types, result.fetchall()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(normal(row[i]) for i in order) for row in rows
    )
