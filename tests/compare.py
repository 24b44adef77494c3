"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(value: object) -> object:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        return round(float(value), 6) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def canonical(columns: list[str], rows: list) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else a short account of what differs."""
    columns, ours = canonical(df.columns, df.collect())
    result = con.execute(sql)
    expected_columns, expected = canonical([c[0] for c in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if ours == expected:
        return None
    extra, missing = list((ours - expected).items())[:2], list((expected - ours).items())[:2]
    return f"{sum(ours.values())} rows, expected {sum(expected.values())}; extra {extra}; missing {missing}"
