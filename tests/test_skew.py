"""All queries on tables in which one key holds a third of the rows, and some keys are null."""

from __future__ import annotations

from functools import partial

import pytest
from compare import OWN, TABLES, assert_same, duck
from pyspark.sql import functions as F

import __spark_entry__ as contract
from marlgrid.plans import events
from marlgrid.sources.tables import SCHEMAS

SF = "/root/testdata/sf0.01"

# Table: row number that decides, and the key columns that become hot or null.
HOT = {
    "orders": ("o_orderkey", ["o_custkey"]),
    "lineitem": ("l_suppkey", ["l_orderkey", "l_partkey"]),
    "events": ("event_id", ["user_id"]),
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        if name in HOT:
            number, keys = HOT[name]
            for key in keys:
                hot = F.when(F.col(number) % 3 == 0, 7).when(F.col(number) % 17 == 1, None)
                table = table.withColumn(key, hot.otherwise(F.col(key)).cast("bigint"))
        table.repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return folder


def skewed_duck(folder):
    con = duck(SF)
    for name in SCHEMAS:
        con.execute(
            f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'"
        )
    return con


@pytest.fixture
def scale(conf):
    """Broadcasts as at scale: only tables of a few rows stay below the threshold."""
    conf("spark.sql.autoBroadcastJoinThreshold", "16000")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "16000")


@pytest.mark.parametrize("name", OWN)
def test_query_on_skewed_tables(spark, skewed, scale, name):
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert assert_same(query(spark, skewed), skewed_duck(skewed), sql) > 0


def test_query_with_long_keys(spark, skewed, scale, monkeypatch):
    limited = partial(events.carry_forward, rows_per_task=1000)
    monkeypatch.setattr(events, "carry_forward", limited)
    name = "last_view_before_purchase"
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    result = query(spark, skewed)
    # The written table of long keys is joined, so a key was long.
    assert "long-keys" in result._jdf.queryExecution().executedPlan().toString()
    assert assert_same(result, skewed_duck(skewed), sql) > 0


def test_sessions_in_many_slices(spark, skewed, scale, monkeypatch):
    sliced = partial(events.sessionize, buckets_per_slice=3)
    monkeypatch.setattr(events, "sessionize", sliced)
    query, sql = contract.queries()["user_sessions"], contract.oracle_sql()["user_sessions"]
    assert assert_same(query(spark, skewed), skewed_duck(skewed), sql) > 0
