"""Windowed sums and counts over a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stream_window_sums(
    stream: DataFrame,
    time: str,
    slide: timedelta,
    by: Sequence[str],
    sums: Mapping[str, Column],
    panes: int = 1,
) -> DataFrame:
    """The streaming form of ``window_sums``; ``time`` carries a watermark.

    A window is emitted once, when the watermark has passed its end. Sliding
    windows are summed from panes in a second stage, as in the batch form.
    """
    slide_text = f"{slide.total_seconds():.6f} seconds"
    width_text = f"{(slide * panes).total_seconds():.6f} seconds"
    result = stream.groupBy(F.window(time, slide_text).alias("_window"), *by).agg(
        *[agg.alias(name) for name, agg in sums.items()]
    )
    if panes > 1:
        result = (
            result.groupBy(F.window("_window", width_text, slide_text).alias("_wide"), *by)
            .agg(*[F.sum(name).alias(name) for name in sums])
            .withColumnRenamed("_wide", "_window")
        )
    return result.select(
        F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_window.end").cast("timestamp_ntz").alias("window_end"),
        *by,
        *sums,
    )
