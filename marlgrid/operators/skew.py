"""Telling keys that one task can hold from keys that it cannot."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.sources.scratch import materialize

# Rows of one key that a single task may sort.
ROWS_PER_TASK = 5_000_000

# Rows that stand for ROWS_PER_TASK when key sizes are estimated; their number
# is off by a few percent at most.
SAMPLED_ROWS = 10_000


class KeySplit(NamedTuple):
    """Rows of short keys, and rows of long keys or None if there are none."""

    short: DataFrame
    long: DataFrame | None
    long_rows: int


def split_by_key_size(df: DataFrame, by: str, rows_per_task: int) -> KeySplit:
    """Splits off the rows of every key that has more than ``rows_per_task`` rows.

    Both parts together are all rows of ``df``; callers get the same result for a
    key whichever part it is in. So it is enough to estimate the size of the keys:
    one column is read and a fraction of a percent of its rows are counted. Keys
    of at most ``SAMPLED_ROWS`` rows per task are counted in full. A null key
    counts as a key.

    The long keys, at most about one per ``rows_per_task`` rows of input, are
    written, so that the parts cannot overlap, and so that the planner decides by
    their measured size whether to broadcast them.
    """
    fraction = min(1.0, SAMPLED_ROWS / rows_per_task)
    counted = df.select(by) if fraction == 1.0 else df.select(by).sample(fraction, seed=1)
    counts = counted.groupBy(by).agg(F.count("*").alias("_rows"))
    long_keys = counts.filter(F.col("_rows") > rows_per_task * fraction)
    long_rows = long_keys.agg(F.sum("_rows")).first()[0]
    if long_rows is None:
        return KeySplit(df, None, 0)
    keys = materialize(long_keys.select(F.col(by).alias("_long")), "long-keys")
    same = F.col(by).eqNullSafe(F.col("_long"))
    return KeySplit(
        df.join(keys, same, "left_anti"),
        df.join(keys, same, "left_semi"),
        int(long_rows / fraction),
    )
