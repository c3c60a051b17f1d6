"""Run a catalogued query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return x if x is None or isinstance(x, (bool, str)) else repr(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((_value(r[i]) is None, str(_value(r[i]))) for i in order) for r in rows)


def compare(spark, con, query, sql, folder) -> str | None:
    """None when both agree, else what differs."""
    df = query(spark, folder)
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c: t for c, t in df.dtypes}
    sql_kinds = {d[0]: str(d[1]) for d in cursor.description}
    wide = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: (k, sql_kinds[c]) for c, k in kinds.items() if wide.get(k) != sql_kinds[c]}
    if not theirs:
        return "no rows to compare"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    a, b = _rows(df.columns, ours), _rows(names, theirs)
    if a != b:
        differing = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(differing)} of {len(a)} rows differ, types {odd}, first {sorted(names)}: {differing[0]}"
    return f"types {odd}" if odd else None
