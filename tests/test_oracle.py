"""Each registered query against its statement, over the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES
from checks.verify import compare, connect


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, sf_dir, name):
    verdict, _ = compare(spark, database, sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0
