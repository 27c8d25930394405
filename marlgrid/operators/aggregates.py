"""Aggregation shapes that reduce rows before they are copied or moved."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_of_sums(
    df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column], level: str = "level"
) -> DataFrame:
    """Sums and counts over every prefix of ``dims``.

    ``sums`` are aggregates whose results can be added up again. ``rollup`` copies
    each input row once per prefix; here the rows are first reduced to the finest
    groups and only those are copied.
    ``level`` is ``grouping_id``: it tells a subtotal's null from a null in the data.
    """
    finest = df.groupBy(*dims).agg(*[agg.alias(name) for name, agg in sums.items()])
    return finest.rollup(*dims).agg(
        F.grouping_id().cast("int").alias(level),
        *[F.sum(name).alias(name) for name in sums],
    )


def window_sums(
    df: DataFrame,
    time: str,
    slide: timedelta,
    by: Sequence[str],
    sums: Mapping[str, Column],
    panes: int = 1,
) -> DataFrame:
    """Sums and counts per time window and ``by`` group, with ``window_start`` and ``window_end``.

    ``sums`` are aggregates whose results can be added up again.
    Windows start every ``slide`` and are ``panes`` slides long, so with the
    default of one pane they tumble. A row of a sliding window belongs to
    ``panes`` windows; rows are summed per pane first and only the panes are
    copied into their windows.
    """
    slide_text = f"{slide.total_seconds():.6f} seconds"
    width_text = f"{(slide * panes).total_seconds():.6f} seconds"
    result = df.groupBy(F.window(time, slide_text).alias("_window"), *by).agg(
        *[agg.alias(name) for name, agg in sums.items()]
    )
    if panes > 1:
        result = (
            result.withColumn("_pane", F.col("_window.start"))
            .groupBy(F.window("_pane", width_text, slide_text).alias("_wide"), *by)
            .agg(*[F.sum(name).alias(name) for name in sums])
            .withColumnRenamed("_wide", "_window")
        )
    return result.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *by,
        *sums,
    )
