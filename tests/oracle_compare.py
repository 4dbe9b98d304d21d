"""Compare a Spark result with a DuckDB result: same names, same rows, same values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def counted_rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = counted_rows(names, result.fetchall())
    actual = counted_rows(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return None
    extra, absent = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, {sum(expected.values())} expected; "
        f"{sum(extra.values())} extra e.g. {list(extra)[:3]}; "
        f"{sum(absent.values())} absent e.g. {list(absent)[:3]}"
    )
