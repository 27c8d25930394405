"""Batch queries over the events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.functions.money import amount, exact_sum
from marlgrid.functions.properties import json_field
from marlgrid.operators.aggregates import window_sums
from marlgrid.operators.asof import asof_join, carry_forward
from marlgrid.operators.sessions import sessionize
from marlgrid.sources.tables import read_table, units_of

SESSION_GAP = timedelta(hours=6)


def event_sums() -> dict[str, Column]:
    """Number of events and their value in cents."""
    return {"n_events": F.count("*"), "value_units": exact_sum(units_of("value"))}


def daily_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their value per type and day."""
    return _counts(spark, sf_dir, timedelta(days=1), 1)


def sliding_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their value per type and 24 hours, every 6 hours."""
    return _counts(spark, sf_dir, timedelta(hours=6), 4)


def _counts(spark: SparkSession, sf_dir: str, slide: timedelta, panes: int) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return window_sums(events, "ts", slide, ["event_type"], event_sums(), panes).select(
        "window_start",
        "window_end",
        "event_type",
        "n_events",
        amount(F.col("value_units"), 2).alias("total_value"),
    )


def last_view_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the user's latest view at or before it, if there is one."""
    is_purchase = F.col("event_type") == "purchase"
    moves = (
        read_table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("view", "purchase"))
        .select("user_id", "ts", "event_id", is_purchase.alias("is_purchase"))
    )
    # At one instant a view counts as being before a purchase.
    order = ["ts", "is_purchase", "event_id"]
    is_view = ~F.col("is_purchase") & F.col("ts").isNotNull()
    view = F.when(is_view, F.struct("event_id", "ts"))
    return (
        carry_forward(moves, "user_id", order, view, "view")
        .filter("is_purchase")
        .select(
            "user_id",
            F.col("event_id").alias("purchase_id"),
            F.col("ts").alias("purchase_ts"),
            F.col("view.event_id").alias("view_id"),
            F.col("view.ts").alias("view_ts"),
        )
    )


def last_click_before_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error with the user's latest click strictly before it, if there is one."""
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    joined = asof_join(
        events.filter(F.col("event_type") == "error").drop("event_type"),
        events.filter(F.col("event_type") == "click").drop("event_type"),
        by="user_id",
        time="ts",
        tie="event_id",
        out="click",
        inclusive=False,
    )
    return joined.select(
        "user_id",
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("error_ts"),
        F.col("click.event_id").alias("click_id"),
        F.col("click.ts").alias("click_ts"),
    )


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's sessions, with a gap of six hours between them."""
    sums = {
        "n_purchases": F.count_if(F.col("event_type") == "purchase"),
        "value_units": exact_sum(units_of("value")),
    }
    events = read_table(spark, sf_dir, "events")
    return sessionize(events, "user_id", "ts", SESSION_GAP, sums).select(
        "user_id",
        "session_start",
        "last_event",
        "n_events",
        "n_purchases",
        amount(F.col("value_units"), 2).alias("total_value"),
    )


def event_property_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the ``k`` property per event type."""
    k = F.col("k")
    return (
        read_table(spark, sf_dir, "events")
        .select("event_type", json_field(F.col("props"), "k", "int").alias("k"))
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n_events"),
            F.count(k).alias("n_with_k"),
            F.countDistinct(k).alias("distinct_k"),
            F.min(k).alias("min_k"),
            F.max(k).alias("max_k"),
            (F.sum(k.cast("bigint")).cast("double") / F.count(k)).alias("avg_k"),
        )
    )
