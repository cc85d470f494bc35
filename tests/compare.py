"""Runs registered queries next to their SQL and reports differences."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


# SQL type names and the Spark types they stand for.
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def difference(df, connection, sql: str) -> str | None:
    """None when equal in columns, types and rows, else what differs first."""
    result = connection.execute(sql)
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if kinds != dict(df.dtypes):
        return f"types {sorted(set(dict(df.dtypes).items()) ^ set(kinds.items()))}"
    _, want = rows_of(list(kinds), result.fetchall())
    names, got = spark_rows(df)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{dict(zip(names, mine))} against {dict(zip(names, theirs))}"
    return None
