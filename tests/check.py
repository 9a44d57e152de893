"""Runs one query in Spark and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return names, cursor.fetchall(), types


def canonical(names, rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value
