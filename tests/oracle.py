"""Spark rows against the rows that DuckDB gives for a query's SQL: columns by name, rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def plain(value):
    """A value that compares and sorts alike, whichever engine made it."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def duck(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    return sorted(columns), rows_of(columns, found.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())
