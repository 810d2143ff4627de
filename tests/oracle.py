"""Compares a query with its SQL over the same tables."""

from __future__ import annotations

import datetime
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def same(df, sql: str, sf_dir: str) -> int:
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    found = connection(sf_dir).sql(sql)
    columns = list(found.columns)
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert got == want
    return len(got)
