"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as driver
from workload.catalog import QUERIES
from workload.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
