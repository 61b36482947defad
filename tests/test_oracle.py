"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from compare import differences, duck
from framequarry.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_same_as_sql(spark, con, name):
    assert differences(spark, catalogue.QUERIES[name], catalogue.SQL[name], FOLDER, con) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
