"""Every query with SQL gives DuckDB's rows on the smallest tables, where those are there."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from kerbside.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    mine = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    made = duck.sql(ORACLES[name])
    assert sorted(made.columns) == names
    order = [made.columns.index(c) for c in names]
    theirs = [tuple(plain(r[i]) for i in order) for r in made.fetchall()]
    assert sorted(mine, key=str) == sorted(theirs, key=str)


def test_sql_only_for_known_queries():
    assert set(ORACLES) <= set(QUERIES)
