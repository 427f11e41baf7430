"""Every registered query against its SQL on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from harrow.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def canon(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return str(v)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in names) for r in df.collect()), key=str)
    sql = catalog.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql)
        assert sorted(want.columns) == names
        at = [want.columns.index(c) for c in names]
        assert got == sorted((tuple(canon(r[k]) for k in at) for r in want.fetchall()), key=str)
