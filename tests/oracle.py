"""Compares a Spark result with DuckDB's result of SQL over the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/*.parquet')" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return round(value, 5) if isinstance(value, float) else value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(cell(r[k]) for k in order) for r in data), key=repr)


def assert_same(df, con, sql: str) -> None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())
