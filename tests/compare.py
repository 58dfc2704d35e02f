"""Side-by-side run of a query on Spark and of its SQL on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    return repr(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(v) for v in row) for row in df.select(*names).collect())


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def difference(df, con, sql: str) -> str | None:
    """None when columns and rows agree, else what differs first."""
    names, ours = spark_rows(df)
    expected_names, expected = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(ours) != len(expected):
        return f"rows {len(ours)} != {len(expected)}"
    for mine, other in zip(ours, expected, strict=True):
        if mine != other:
            cells = [(n, a, b) for n, a, b in zip(names, mine, other, strict=True) if a != b]
            return f"{cells[:5]} in {mine[:6]}"
    return None
