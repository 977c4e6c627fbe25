"""Every query against the same query in SQL, on the smallest driver tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from ctrprep.plans.queries import CATALOGUE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(r[k] for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_matches_sql(spark, oracle, name):
    got = driver.queries()[name](spark, FOLDER)
    expected = oracle.execute(driver.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    assert bag(got.columns, map(tuple, got.collect())) == bag(names, expected.fetchall())


def test_every_query_has_an_oracle():
    assert CATALOGUE.keys() <= driver.oracle_sql().keys()
    assert CATALOGUE.keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).columns == ["value"]
