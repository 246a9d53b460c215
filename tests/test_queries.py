"""Every registered query against its oracle SQL on the generated tables."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as registry
from fiscalmill.demo.oracles import ORACLES
from fiscalmill.demo.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf_dir, connection, name):
    assert difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0
