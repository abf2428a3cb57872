"""Every registered query against its SQL on the smallest data set."""

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, sf_dir, con, name):
    difference = oracle.compare(queries()[name](spark, sf_dir), con, oracle_sql()[name])
    assert difference is None, difference
