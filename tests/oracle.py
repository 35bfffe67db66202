"""Compare a query with its SQL on DuckDB, as sorted rows."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def rows(columns, found):
    order = sorted(columns)
    at = [list(columns).index(c) for c in order]
    clean = lambda v: round(v, 6) if isinstance(v, float) else v
    return order, sorted((tuple(clean(r[i]) for i in at) for r in found), key=repr)


def check(spark, folder, query, sql):
    df = query(spark, folder)
    con = connect(folder).execute(sql)
    want = rows([d[0] for d in con.description], con.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want
