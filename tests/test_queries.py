"""Every query with an oracle gives the same rows as an independent SQL engine."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, connect

ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, sf_dir, name):
    assert compare(con, QUERIES[name](spark, sf_dir), ORACLES[name]) == ""


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    found = entry_module.entry(spark)
    assert found.columns == ["city", "ppsqm"]
    assert 0 < found.count() <= 25


@pytest.mark.parametrize("name", ["page_nested_fields", "prepared_listings", "gbt_scores", "importances", "scored_requests"])
def test_runs_without_oracle(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()
