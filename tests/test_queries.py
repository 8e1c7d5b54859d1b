"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    problem, _, count = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF)
    assert problem is None
    assert count > 0


def test_entry(spark):
    assert entry(spark).count() > 0
