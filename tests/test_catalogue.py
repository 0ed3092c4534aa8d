"""Every query with an SQL twin gives the twin's rows."""

import glob
import os

import duckdb
import pytest

from usagelens.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_twin(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(plain(tuple(r[c] for c in cols))) for r in df.collect())
    twin = duck.sql(catalogue.oracle_sql()[name])
    at = [list(twin.columns).index(c) for c in cols]
    assert sorted(twin.columns) == cols
    assert got == sorted(repr(plain(tuple(r[i] for i in at))) for r in twin.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
