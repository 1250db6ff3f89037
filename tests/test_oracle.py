"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import check, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.QUERIES, entry.ORACLE


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    wrong, _, _, _ = check(spark, connection, SF_DIR, name, QUERIES, ORACLE)
    assert wrong is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 30
