"""Registered corpus queries that SQL can express, against their SQL on the smallest tables; the others must run and give whole results."""

import glob
import os

import duckdb
import pytest

from harrow.llm import queries as llm

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", list(llm.queries()))
def test_query(spark, name):
    df = llm.queries()[name](spark, DATA)
    rows = df.collect()
    assert rows
    if name in llm.oracle_sql():
        c = duckdb.connect()
        for f in glob.glob(f"{DATA}/*.parquet"):
            c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        want = c.sql(llm.oracle_sql()[name])
        names = sorted(df.columns)
        assert names == sorted(want.columns)
        at = [want.columns.index(n) for n in names]
        assert sorted((tuple(r[n] for n in names) for r in rows), key=str) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=str)
