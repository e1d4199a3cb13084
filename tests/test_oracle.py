"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    result = compare.spark_rows(QUERIES[name](spark, FOLDER))
    assert compare.difference(result, compare.duck_rows(duck, ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["indicator", "importance", "latest", "previous", "delta"]
