"""Removal of repeated deliveries from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(stream: DataFrame, keys: Sequence[str], salts: int = 0) -> DataFrame:
    """One row per ``keys`` among rows that arrive within the stream's watermark delay.

    The state holds every key until the watermark has passed it. A source that resends one
    key very often would send all copies to one task; with ``salts`` a first round drops
    repeats among the rows of neighbouring input splits, at the price of a second
    state of the same size.

    The watermark moves between micro-batches only, so a backlog that is one micro-batch is held
    whole. Where files arrive in time order, read it with ``stream_table(...,
    max_bytes_per_trigger=...)`` and a watermark delay that covers how far files
    overlap: state then falls from one micro-batch to the next, and no row is late. Files in
    any other order must stay one micro-batch, or late rows are dropped.
    """
    if salts:
        split = F.pmod(F.spark_partition_id(), F.lit(salts))
        stream = (
            stream.withColumn("_salt", split)
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return stream.dropDuplicatesWithinWatermark(list(keys))
