"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb

from loanmart.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{v:.9g}" if isinstance(v, float) and v != int(v) else str(int(v))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, sf_dir: str, fn, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of differences (empty when equal)."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, df.collect())
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    faults = []
    if sorted(df.columns) != sorted(rel.columns):
        faults.append(f"columns {sorted(set(df.columns) ^ set(rel.columns))}")
    if len(got) != len(want):
        faults.append(f"{len(got)} rows, expected {len(want)}")
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        if pairs:
            cols = sorted(df.columns)
            g, w = pairs[0]
            faults.append(f"{len(pairs)} rows differ, first: " + "; ".join(
                f"{c}: {a!r} / {b!r}" for c, a, b in zip(cols, g, w) if a != b)[:900])
    return len(got), faults
