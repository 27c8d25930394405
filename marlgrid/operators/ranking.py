"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    salts: int = 256,
) -> DataFrame:
    """The first ``k`` rows of each ``by`` group, numbered from 1 in ``rank``.

    ``order`` must be a total order within a group; the result is then unique.

    Groups may be few and huge. Up to ``windowGroupLimitThreshold`` Spark cuts
    each map task's rows to ``k`` per group before the shuffle. Beyond that a
    first round does it on ``salts`` parts of every group: no row outside the
    first ``k`` of its part can be among the first ``k`` of the group.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:
        row = F.xxhash64(*[F.col(name) for name in df.columns])
        df = df.withColumn("_salt", F.pmod(row, F.lit(salts)))
        df = _first_k(df, [*by, "_salt"], order, k, "_part_rank").drop("_salt", "_part_rank")
    return _first_k(df, by, order, k, rank)


def _first_k(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, number).filter(F.col(rank) <= k)
