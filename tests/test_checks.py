"""Every registered query against its SQL twin, and the registry itself."""

import pytest
from verify_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from ridgepole.checks import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, queries()[name], oracle_sql()[name], sf_dir) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
