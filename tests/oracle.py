"""Compare registered queries with their SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    place = [columns.index(n) for n in names]
    return names, sorted((tuple(_cell(r[i]) for i in place) for r in found.fetchall()), key=repr)


def difference(df, con, sql) -> str | None:
    """None when both sides agree exactly, in names, types of cells and values."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if repr(left) == repr(right):
        return None
    left_set, right_set = {repr(r) for r in left}, {repr(r) for r in right}
    return (
        f"{len(left_set - right_set)} rows differ {left_names}\n"
        f"  spark only {sorted(left_set - right_set)[:3]}\n  sql only {sorted(right_set - left_set)[:3]}"
    )
