"""Runs registered queries beside their SQL and compares the results."""

from __future__ import annotations

import math
import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_normal(row[i]) for i in order) for row in rows), key=lambda r: [str(v) for v in r]
    )


def difference(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if query and SQL agree, else the first difference."""
    df = query(spark, sf_dir)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    relation = connection.sql(sql)
    theirs = _rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in theirs][:3], [r for r in theirs if r not in ours][:3]
        return f"{len(ours)} rows != {len(theirs)}: {extra}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None
