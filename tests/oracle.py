"""Holds Spark rows against DuckDB rows of the same tables."""

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def assert_same(df, sql: str, con) -> int:
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    columns = sorted(names)
    assert sorted(df.columns) == columns
    want = sorted(repr(tuple(plain(row[names.index(c)]) for c in columns)) for row in answer.fetchall())
    got = sorted(repr(tuple(plain(row[c]) for c in columns)) for row in df.collect())
    assert got == want
    return len(got)
