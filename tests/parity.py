"""Compare a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    return x


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr_key)


def repr_key(row):
    return [("", repr(float(x))) if isinstance(x, (int, float)) else ("s", repr(x)) for x in row]


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return canonical(list(rel.columns), rel.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short account of the difference."""
    names, rows = spark_rows(df)
    other_names, other = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(rows) != len(other):
        return f"{len(rows)} rows against {len(other)}"
    bad = [(a, b) for a, b in zip(rows, other) if a != b]
    return f"{len(bad)} of {len(rows)} rows differ, first: {bad[0]}" if bad else None
