"""Side-by-side check of a Spark query and its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr), [columns[i] for i in order]


def compare(df, sql: str, con) -> str | None:
    """None when equal, else what differs."""
    spark_rows, spark_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    duck_rows, duck_cols = rows_of([d[0] for d in cur.description], cur.fetchall())
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows, strict=True) if a != b]
    return f"{len(bad)} of {len(spark_rows)} rows differ, e.g. {bad[0][0]} != {bad[0][1]} ({spark_cols})" if bad else None
