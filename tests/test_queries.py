"""Every registered query against its check SQL on the smallest tables."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries

CHECKS = oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, sf_dir, name):
    good, note = compare.compare(spark, connection, sf_dir, queries()[name], CHECKS.get(name))
    assert good, note


def test_entry(spark):
    assert entry(spark).count() == 7


def test_checks_have_queries():
    assert set(CHECKS) <= set(queries())
