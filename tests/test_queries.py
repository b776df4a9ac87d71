"""Every registered query equals its SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, database
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    outcome = compare(spark, con, name, sf_dir)
    assert outcome.startswith("ok"), outcome


def test_entry_is_not_empty(spark):
    assert entry.entry(spark).count() == 1
