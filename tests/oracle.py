"""A query's rows against its oracle SQL on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in sorted(glob.glob(f"{folder}/*.parquet")):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, sql: str, con: duckdb.DuckDBPyConnection) -> str:
    """'' if columns and rows agree, else what differs."""
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs, ours = rows_of(names, r.fetchall()), rows_of(df.columns, [tuple(x) for x in df.collect()])
    if ours == theirs:
        return ""
    only = [x for x in ours if x not in set(theirs)][:3] if len(ours) < 50_000 else []
    other = [x for x in theirs if x not in set(ours)][:3] if len(ours) < 50_000 else []
    return f"{len(ours)} rows against {len(theirs)}; only ours {only}; only theirs {other}"
