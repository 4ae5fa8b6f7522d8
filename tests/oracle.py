"""Compares queries with their SQL in DuckDB."""

import glob
import math
import os

import duckdb


def connect(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9) + 0.0
    return tuple(map(plain, x)) if isinstance(x, list | tuple) else x


def compare(spark, sf, query, sql):
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = connect(sf).sql(sql)
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(row[i]) for i in at) for row in r.fetchall()), key=repr)
