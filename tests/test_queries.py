"""Every registered query against its SQL in DuckDB; queries without SQL must give rows."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SLOW = {n for n, f in queries().items() if f.__module__.endswith("model_queries")} | {"campaign_contacts"}


@pytest.fixture(scope="module")
def db(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query(spark, db, folder, name):
    assert check.compare(spark, db, folder, name) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
