"""A query of Spark against the same in SQL, as sorted rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connected(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    return (None if math.isnan(v) else float(f"{v:.12g}")) if isinstance(v, float) else v


def assert_same(df, con, sql: str) -> None:
    told = con.sql(sql)
    assert sorted(df.columns) == sorted(told.columns)
    at = [told.columns.index(c) for c in df.columns]
    mine = sorted((tuple(map(_plain, r)) for r in df.collect()), key=repr)
    other = sorted((tuple(_plain(r[k]) for k in at) for r in told.fetchall()), key=repr)
    assert mine == other
