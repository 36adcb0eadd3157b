"""Side-by-side check of a Spark query and its DuckDB oracle (row count,
column names, order-insensitive values), as the driver does it."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 6))
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (5, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (6, tuple(_norm(x) for x in v))
    return (7, str(v))


def canon(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark type name -> DuckDB type name, for the schema part of the check.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    bad = {c: (s_types[c], d_types[c]) for c in s_cols if TYPE_NAMES.get(s_types[c], s_types[c]) != d_types[c]}
    if bad:
        return False, f"types differ: {bad}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    return True, f"{len(s_rows)} rows"
