"""Compare a Spark result with what DuckDB returns for the query's SQL."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    relation = con.execute(sql)
    names, expected = canonical([d[0] for d in relation.description], relation.fetchall())
    found_names, found = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != found_names:
        return f"columns {found_names} instead of {names}"
    if len(found) != len(expected):
        return f"{len(found)} rows instead of {len(expected)}"
    different = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
