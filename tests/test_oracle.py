"""Every query with check SQL, on the smallest test set."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

DIRECTORY = "/root/testdata/sf0.001"
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, DIRECTORY), duck, CHECKS[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(entry.queries())
