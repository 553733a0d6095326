"""The driver contract, with or without the training-data subpackage."""

import duckdb
import pytest

import __spark_entry__ as driver
from girder.plans import registry
from tests.compare import same_rows


def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() == 3


def test_oracles_name_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_oracle(spark, sf_dir, name):
    with duckdb.connect() as db:
        same_rows(driver.queries()[name](spark, sf_dir), db, sf_dir, driver.oracle_sql()[name])
