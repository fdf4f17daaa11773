"""Runs registered queries beside their SQL in DuckDB."""

import glob
import math
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(str(plain(r[i])) for i in order) for r in rows), key=str)


def agree(spark, query, sql, data=DATA):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found, wanted = query(spark, data), con.sql(sql)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows_of(found.collect(), found.columns) == rows_of(wanted.fetchall(), wanted.columns)
