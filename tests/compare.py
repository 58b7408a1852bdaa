"""Rows of a query against those of its SQL."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple, np.ndarray)) and not hasattr(v, "asDict"):
        return tuple(map(plain, v))
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    return v.isoformat()[:19] if hasattr(v, "isoformat") else v


def connection(folder):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def same(df, con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in got.fetchall()), key=repr)
    have = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert have == want
