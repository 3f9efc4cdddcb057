"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as repo
from shelfmatch.plans.views import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def shown(rows, order):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(repo.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = repo.queries()[name](spark, FOLDER)
    result = duck.execute(repo.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(columns)
    rows = found.collect()
    assert shown(rows, [found.columns.index(c) for c in columns]) == shown(result.fetchall(), range(len(columns)))


def test_entry(spark):
    assert repo.entry(spark).count() > 0
