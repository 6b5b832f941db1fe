"""Every registered query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from millrace import queries as base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    return v


@pytest.mark.parametrize("name", sorted(base.ORACLE))
def test_matches_sql(spark, db, name):
    df = base.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = db.sql(base.ORACLE[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=str)


def test_all_but_few_have_sql():
    assert set(base.QUERIES) - set(base.ORACLE) == set()
