"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracle import SQL
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    ok, text = compare(spark, duck, SF, name)
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
