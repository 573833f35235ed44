"""Compares a query with its SQL on the same tables: column names, row count and values in any order."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        src = f"{p}/*.parquet" if os.path.isdir(p) else str(p)
        con.execute(f"create view {p.stem} as select * from read_parquet('{src}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def differences(spark, con, query, sql: str, sf_dir: str) -> str:
    got = query(spark, sf_dir)
    want = con.execute(sql)
    columns = sorted(c[0] for c in want.description)
    if sorted(got.columns) != columns:
        return f"columns {sorted(got.columns)} and {columns}"
    names = [c[0] for c in want.description]
    order = [names.index(c) for c in columns]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=key)
    ours = sorted((tuple(plain(x) for x in r) for r in got.select(columns).collect()), key=key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(bad)} rows differ, such as {bad[0]}" if bad else ""
