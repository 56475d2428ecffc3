"""Every query with SQL gives the SQL's rows on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 9)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
