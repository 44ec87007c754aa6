"""Every registered query against its SQL in DuckDB, on whole tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from netvigil.registry import ORACLES, QUERIES



@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 7
