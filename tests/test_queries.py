"""Every registered query against its expected SQL."""

import pytest

import __spark_entry__ as entry_points
from compare import database, differences
from tidelog.plans import catalog, expected

NAMES = sorted(catalog.all_queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_an_expectation():
    assert set(NAMES) == set(expected.all_expected())
    assert set(NAMES) <= set(entry_points.queries()) and set(NAMES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    result = entry_points.queries()[name](spark, sf_dir)
    assert differences(result, con, entry_points.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_settings_survive_a_plain_session(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
