"""Compares a Spark query with its SQL twin on the same Parquet tables."""

import os
from pathlib import Path

import duckdb


def shown(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float) or hasattr(v, "quantize"):
        return repr(round(float(v), 6))
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())


def sql_rows(sf, sql):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}{'/*.parquet' if os.path.isdir(f) else ''}'")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(shown(r[i]) for i in order) for r in got.fetchall())
