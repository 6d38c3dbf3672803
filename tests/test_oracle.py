"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_points
from fleetwright.plans.catalog import QUERIES
from fleetwright.plans.oracle import ORACLE as SQL
from tests.oracle import assert_same, connect

# Results that are empty by right: the fleet's keys are unique.
MAY_BE_EMPTY = {"key_violations"}


@pytest.fixture(scope="module")
def oracle(testdata):
    con = connect(testdata / "sf0.01")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, testdata, oracle, name):
    df = QUERIES[name](spark, str(testdata / "sf0.01"))
    rows = assert_same(df, oracle, SQL[name])
    assert rows > 0 or name in MAY_BE_EMPTY


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5
