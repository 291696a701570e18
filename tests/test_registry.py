"""Every catalogue query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from tallystone.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, DIR)
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.ORACLES:
        return
    oracle = con.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(oracle.columns)
    assert found == rows(oracle.columns, oracle.fetchall())
