"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, con, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "employee_id", "social_year", "activities", "distance_meters", "duration_sec"]
