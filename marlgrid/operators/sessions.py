"""Sessions: runs of events per key without a long gap."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Gap-wide buckets of one key that a task may have to put in order.
BUCKETS_PER_SLICE = 100_000


def sessionize(
    df: DataFrame,
    by: str,
    time: str,
    gap: timedelta,
    sums: Mapping[str, Column],
    buckets_per_slice: int = BUCKETS_PER_SLICE,
) -> DataFrame:
    """One row per session with ``session_start``, ``last_event``, ``n_events`` and ``sums``.

    An event joins the session before it if it follows that session's last event
    by ``gap`` or less; this is what ``session_window`` does. An event without a
    time is in no session. ``sums`` are aggregates whose results can be added up again.

    Two events of one key in the same gap-wide bucket are always in one session, so the rows
    are first summed per key and bucket, on the map side. Buckets are put in order
    within slices of time, so that no key, however long and short of gap, makes one
    task sort all of it. Only sessions at the edge of a slice, two per key and
    slice at most, then meet across slices.
    """
    seconds = f"{gap.total_seconds():.6f}"
    bucket = F.window(time, f"{seconds} seconds").getField("start")
    buckets = df.groupBy(by, bucket.alias("_bucket")).agg(
        F.min(time).alias("session_start"),
        F.max(time).alias("last_event"),
        F.count("*").alias("n_events"),
        *[agg.alias(name) for name, agg in sums.items()],
    )
    width = gap * buckets_per_slice
    micros = F.unix_micros(F.col("_bucket").cast("timestamp"))
    length = int(width / timedelta(microseconds=1))
    sliced = buckets.withColumn("_slice", F.floor(micros / F.lit(length)))

    in_slice = Window.partitionBy(by, "_slice").orderBy("_bucket")
    numbered = sliced.withColumn("_session", _number(in_slice, seconds))
    last = F.max("_session").over(Window.partitionBy(by, "_slice"))
    parts = numbered.withColumn("_edge", (F.col("_session") == 1) | (F.col("_session") == last))
    parts = _merge(parts, [by, "_slice", "_session", "_edge"], sums)

    across = Window.partitionBy(by).orderBy("session_start")
    edges = parts.filter("_edge").withColumn("_whole", _number(across, seconds))
    whole = _merge(edges, [by, "_whole"], sums).drop("_whole")
    inner = parts.filter("NOT _edge").select(*whole.columns)
    return inner.unionByName(whole)


def _number(in_order: Window, seconds: str) -> Column:
    """The number of the session that a row is in, from 1, among the rows of its window."""
    idle = F.col("session_start") - F.lag("last_event").over(in_order)
    opens = F.coalesce(idle > F.expr(f"INTERVAL '{seconds}' SECOND"), F.lit(True))
    return F.sum(opens.cast("bigint")).over(in_order)


def _merge(rows: DataFrame, keys: list[str], sums: Mapping[str, Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("session_start").alias("session_start"),
        F.max("last_event").alias("last_event"),
        F.sum("n_events").alias("n_events"),
        *[F.sum(name).alias(name) for name in sums],
    )
