"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import decimal
import math
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if getattr(v, "tzinfo", None):
        return v.replace(tzinfo=None)
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def rows_of_sql(sql: str, folder: str):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(names)
    at = [names.index(n) for n in order]
    return order, sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
