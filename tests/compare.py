"""Rows of a Spark query against those of its DuckDB SQL."""

import os

import duckdb


def connect(sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(sf):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object)
    return columns, sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


def assert_same(spark, con, sf, query, sql):
    got, want = query(spark, sf).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:  # a nullable whole number is a float in one of the two
        if got[c].dtype != want[c].dtype and {got[c].dtype.kind, want[c].dtype.kind} <= set("iufb"):
            got[c], want[c] = got[c].astype(float), want[c].astype(float)
    assert rows(got) == rows(want)
