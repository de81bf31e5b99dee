"""Run queries and their SQL side by side and report differences."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "null" if value != value else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return "null" if value is None else f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, name, query, sql, folder):
    """(problem or None, rows, seconds)."""
    started = time.time()
    df = query(spark, folder)
    got = df.collect()
    took = time.time() - started
    if sql is None:
        return None, len(got), took
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), took
    ours = {c: KINDS.get(k, k) for c, k in df.dtypes}
    wrong = {c: (ours[c], kinds[c]) for c in names if ours[c] != kinds[c]}
    a, b = rows_of(df.columns, got), rows_of(names, expected)
    if a != b:
        extra, lacking = [x for x in a if x not in set(b)], [x for x in b if x not in set(a)]
        return f"{len(a)} rows vs {len(b)}; ours {extra[:2]} theirs {lacking[:2]}", len(got), took
    return (f"types {wrong}" if wrong else None), len(got), took
