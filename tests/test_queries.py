"""Every registered query that has SQL gives what DuckDB gives on the smallest tables; the entry point runs."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    return repr(round(float(v), 5) + 0.0) if isinstance(v, (int, float)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    ref = duck.sql(ORACLES[name])
    assert sorted(ref.columns) == columns
    at = [ref.columns.index(c) for c in columns]
    assert mine == sorted(tuple(plain(r[i]) for i in at) for r in ref.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
