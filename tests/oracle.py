"""Spark rows against DuckDB rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}/*.parquet'" if os.path.isdir(path) else f"create view {t} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9)) if v == v and abs(v) != float("inf") else str(v)
    return str(v)


def compare(df, con, sql):
    found = con.sql(sql)
    names = found.columns
    assert sorted(names) == sorted(df.columns)
    at = [df.columns.index(n) for n in names]
    ours = sorted(tuple(plain(r[i]) for i in at) for r in df.collect())
    theirs = sorted(tuple(plain(v) for v in r) for r in found.fetchall())
    assert ours == theirs
