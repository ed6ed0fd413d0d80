"""Every query of the catalogue against its oracle SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from strataloom.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    cur = duck.execute(catalogue.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(repr([plain(dict(zip(names, r))[c]) for c in cols]) for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_without_oracle_runs(spark, name):
    df = catalogue.QUERIES[name](spark, DATA)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 2
    assert set(e.oracle_sql()) <= set(e.queries())
