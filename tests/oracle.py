"""Compares a query with its reference SQL on DuckDB."""

import datetime
import decimal
import glob
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plain(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, list):
        return tuple(map(_plain, x))
    if isinstance(x, datetime.datetime) and x.tzinfo:
        return x.replace(tzinfo=None)
    return x


def agree(spark, query, sql, data=DATA):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = query(spark, data)
    rel = con.sql(sql)
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    ours = sorted((tuple(map(_plain, r)) for r in df.select(*columns).collect()), key=repr)
    theirs = sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert ours == theirs
