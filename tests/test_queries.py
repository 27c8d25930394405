"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from compare import OWN, assert_same, duck

import __spark_entry__ as contract

TESTDATA = "/root/testdata"


def test_every_query_has_sql():
    assert set(OWN) <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["r_name", "o_year", "revenue"]
    assert result.count() > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, name, sf):
    folder = f"{TESTDATA}/{sf}"
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    n_rows = assert_same(query(spark, folder), duck(folder), sql)
    assert n_rows > 0


@pytest.mark.parametrize(
    "name",
    [
        "pricing_summary",
        "revenue_by_region_year",
        "last_view_before_purchase",
        "user_sessions",
        "daily_event_counts",
        "stream_daily_event_counts",
    ],
)
def test_times_do_not_depend_on_the_session_time_zone(spark, conf, name):
    conf("spark.sql.session.timeZone", "America/New_York")
    folder = f"{TESTDATA}/sf0.001"
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert_same(query(spark, folder), duck(folder), sql)
