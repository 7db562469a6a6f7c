"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from pulselake.plans import general, reference, tables

SF = "/root/testdata/sf0.001"
QUERIES = reference.QUERIES | tables.QUERIES | general.queries()
SQL = reference.SQL | tables.SQL | general.oracle_sql()


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NA or v != v:
        return None
    if isinstance(v, float):
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    return v.isoformat().removesuffix("T00:00:00") if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name]).df()
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    want = want[names].astype(object)
    assert sorted((tuple(plain(r[c]) for c in names) for r in got.collect()), key=str) == sorted((tuple(plain(x) for x in r) for r in want.values.tolist()), key=str)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
