"""Rows of a Spark query beside those of its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float | decimal.Decimal):
        return repr(round(float(value), 9))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(_plain(r[c]) for c in names) for r in df.collect())


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def sql_rows(con: duckdb.DuckDBPyConnection, statement: str) -> tuple[list[str], list[tuple]]:
    found = con.execute(statement)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(_plain(r[i]) for i in order) for r in found.fetchall())
