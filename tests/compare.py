"""Order-free comparison of a Spark result with the DuckDB result of its SQL, and plan text."""

import contextlib
import io
import re
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    return _sorted_rows([c[0] for c in result.description], result.fetchall())


def plan(df, mode="simple"):
    """Text of the physical plan, without expression ids."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode)
    return re.sub(r"#\d+L?", "", printed.getvalue())
