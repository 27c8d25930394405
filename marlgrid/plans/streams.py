"""Streaming queries over the events.

Each reads the events as a file stream, processes what is available and returns
what the stream wrote. Windows that the watermark has not closed yet stay in the
stream's state and are not part of the result.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.functions.money import amount
from marlgrid.plans.events import event_sums
from marlgrid.sources.tables import stream_table, units_of
from marlgrid.streaming.dedup import drop_repeats
from marlgrid.streaming.runner import run_once
from marlgrid.streaming.spells import stream_spell_totals
from marlgrid.streaming.windows import stream_window_sums

DELAY = "1 hour"
SPELL_PANE = timedelta(hours=1)
SPELL_IDLE = timedelta(hours=12)


def _events(session: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(session, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _counts(spark: SparkSession, sf_dir: str, name: str, slide: timedelta, panes: int) -> DataFrame:
    def build(session: SparkSession) -> DataFrame:
        events = _events(session, sf_dir).withWatermark("ts", DELAY)
        counts = stream_window_sums(events, "ts", slide, ["event_type"], event_sums(), panes)
        total = amount(F.col("value_units"), 2).alias("total_value")
        return counts.select("window_start", "window_end", "event_type", "n_events", total)

    return run_once(spark, name, build)


def stream_daily_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their value per type and closed day."""
    return _counts(spark, sf_dir, "daily-counts", timedelta(days=1), 1)


def stream_sliding_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their value per type and closed 24 hours, every 6 hours."""
    return _counts(spark, sf_dir, "sliding-counts", timedelta(hours=6), 4)


def stream_deduplicated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from a source that delivers every purchase twice, each once."""

    def build(session: SparkSession) -> DataFrame:
        times = F.when(F.col("event_type") == "purchase", 2).otherwise(1)
        delivered = _events(session, sf_dir).withColumn(
            "_delivery", F.explode(F.sequence(F.lit(1), times))
        )
        unique = drop_repeats(delivered.drop("_delivery").withWatermark("ts", DELAY), ["event_id"])
        ts = F.col("ts").cast("timestamp_ntz").alias("ts")
        return unique.select("event_id", ts, "user_id", "event_type", "value")

    return run_once(spark, "deduplicated-events", build)


def stream_user_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's closed hours with totals since the user was last idle for 12 hours."""

    def build(session: SparkSession) -> DataFrame:
        events = _events(session, sf_dir).withWatermark("ts", DELAY)
        events = events.select("ts", "user_id", units_of("value").alias("units"))
        spells = stream_spell_totals(events, "user_id", "ts", "units", SPELL_PANE, SPELL_IDLE)
        return spells.select(
            "user_id",
            F.col("pane_start").alias("hour_start"),
            F.col("n").alias("n_events"),
            F.col("spell_n").alias("spell_events"),
            amount(F.col("spell_units"), 2).alias("spell_value"),
        )

    return run_once(spark, "user-spells", build)
