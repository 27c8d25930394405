"""As-of joins: for each row, the latest earlier row of another kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlgrid.operators.skew import ROWS_PER_TASK, split_by_key_size
from marlgrid.sources.scratch import materialize


def carry_forward(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    value: Column,
    out: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds ``out``: the last non-null ``value`` at or before each row of the same ``by`` key.

    ``order`` must be a total order within a key. Rows with a null key match
    nothing and get null.

    Keys of up to ``rows_per_task`` rows are handled by one window over the key.
    Longer keys are cut into slices of consecutive rows: each slice carries its
    own values forward, and a row before its slice's first value takes the last
    value of the slices before. ``df`` is read once per part and once to size the
    keys; materialize it first if it is costly to compute.
    """
    df = df.withColumn("_value", value)
    nothing = F.lit(None).cast(df.schema["_value"].dataType)
    keyless = df.filter(F.col(by).isNull()).withColumn(out, nothing)
    keys = split_by_key_size(df.filter(F.col(by).isNotNull()), by, rows_per_task)
    in_key = _up_to_here(Window.partitionBy(by), order)
    result = keys.short.withColumn(out, in_key).unionByName(keyless)
    if keys.long is not None:
        slices = -(-keys.long_rows // rows_per_task)
        result = result.unionByName(_carry_in_slices(keys.long, by, order, out, slices))
    return result.drop("_value")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    time: str,
    tie: str,
    out: str,
    inclusive: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every row of ``left`` with ``out``: the latest ``right`` row of its key, as a struct.

    The latest is the last by (``time``, ``tie``) at or before the left row's
    ``time``, or strictly before it if not ``inclusive``. ``tie`` is unique per
    side among rows of the same key and time. ``out`` is null where nothing matches;
    a null key or time matches nothing.
    """
    right = right.filter(F.col(time).isNotNull())
    whole_left, whole_right = F.struct(*left.columns), F.struct(*right.columns)
    right_side = 0 if inclusive else 1
    both = left.select(
        F.col(by),
        F.col(time).alias("_time"),
        F.lit(1 - right_side).alias("_side"),
        F.col(tie).alias("_tie"),
        whole_left.alias("_left"),
        F.lit(None).cast(right.schema).alias("_right"),
    ).unionByName(
        right.select(
            F.col(by),
            F.col(time).alias("_time"),
            F.lit(right_side).alias("_side"),
            F.col(tie).alias("_tie"),
            F.lit(None).cast(left.schema).alias("_left"),
            whole_right.alias("_right"),
        )
    )
    carried = carry_forward(
        both, by, ["_time", "_side", "_tie"], F.col("_right"), out, rows_per_task
    )
    return carried.filter(F.col("_left").isNotNull()).select("_left.*", out)


def _up_to_here(window, order: Sequence[str]) -> Column:
    frame = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last("_value", ignorenulls=True).over(frame)


def _carry_in_slices(
    df: DataFrame, by: str, order: Sequence[str], out: str, slices: int
) -> DataFrame:
    # Range partitioning cuts the rows, in order, into slices of about equal size
    # wherever the cuts fall. They are written once, because a second sampling
    # could cut elsewhere.
    sliced = materialize(
        df.repartitionByRange(slices, by, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    last_value = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order)))
    ends = sliced.groupBy(by, "_slice").agg(last_value.alias("_end"))
    before = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.last("_end", ignorenulls=True).over(before)
    carried = ends.select(by, "_slice", earlier.alias("_before"))
    in_slice = _up_to_here(Window.partitionBy(by, "_slice"), order)
    return (
        sliced.withColumn("_here", in_slice)
        .join(carried, [by, "_slice"])
        .withColumn(out, F.coalesce("_here", "_before"))
        .drop("_slice", "_here", "_before")
    )
