"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.compare import actual, expected
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_query_is_registered_with_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = actual(QUERIES[name](spark, SF))
    assert got == expected(SF, ORACLES[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
