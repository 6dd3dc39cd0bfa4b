"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from orrery.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def plain(v):
    return round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    q = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in q.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in q.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want
