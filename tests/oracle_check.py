"""Run a named query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

import __spark_entry__ as entry_points


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def differences(spark, name: str, sf_dir: str, con) -> list[str]:
    df = entry_points.queries()[name](spark, sf_dir)
    cursor = con.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = [dict(zip(columns, r)) for r in cursor.fetchall()]
    actual = [r.asDict() for r in df.collect()]
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    order = sorted(columns)
    left = sorted((tuple(plain(r[c]) for c in order) for r in actual), key=sort_key)
    right = sorted((tuple(plain(r[c]) for c in order) for r in expected), key=sort_key)
    found = [f"rows {len(left)} != {len(right)}"] if len(left) != len(right) else []
    found += [f"{order}\n  spark {a}\n  duck  {b}" for a, b in zip(left, right) if a != b][:3]
    types = [
        (c, type(a), type(b))
        for c, a, b in zip(order, left[0] if left else (), right[0] if right else ())
        if type(a) is not type(b) and a is not None and b is not None
    ]
    return found + [f"type {t}" for t in types]
