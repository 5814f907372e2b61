"""Every named query runs; those with reference SQL give the same rows."""

import pytest

from helpers import SF
from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences

SLOW = {"gbt_fraud", "model_comparison"}  # their parts are tested on small tables


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() > 0 and "alert_type" in rows.columns


def test_reference_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_reference(spark, duck, name):
    rows, wrong = differences(queries()[name](spark, SF), duck, oracle_sql()[name])
    assert not wrong
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0
