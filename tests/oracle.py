"""Compares a query with its SQL: column names, row counts and values, in any order."""

from __future__ import annotations

import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def _plain(v):
    if isinstance(v, float | Decimal):
        return "nan" if v != v else f"{float(v):.6f}"
    return [_plain(x) for x in v] if isinstance(v, list | tuple) else v


def rows_of(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(str([(names[i], _plain(r[i])) for i in order]) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    found = con.sql(sql)
    a, b = rows_of(df.columns, df.collect()), rows_of(found.columns, found.fetchall())
    assert len(a) == len(b)
    assert a == b, (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
