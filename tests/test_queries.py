"""Every registered query against its SQL twin on the smallest scale factor."""

import os

import pytest

import __spark_entry__ as contract
import registry
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.load()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, QUERIES[name], ORACLES[name], SF_DIR, con)
    assert problem is None, problem


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
