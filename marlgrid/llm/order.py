"""Places of rows in a sorted sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlgrid.sources.scratch import materialize


def numbered(df: DataFrame, order: list[Column | str], place: str, name: str) -> DataFrame:
    """``df`` with ``place``: its rows' numbers from 0 in the sequence sorted by ``order``.

    Rows are sorted by range partitions and written down, which fixes their places. The
    driver gets one count per partition. Rows that ``order`` does not tell apart come
    in any order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    written = materialize(
        ranged.withColumns({f"{place} part": F.spark_partition_id(), f"{place} at": at}), name
    )
    part = F.col(f"{place} part")
    sizes = {row[0]: row[1] for row in written.groupBy(part).count().collect()}
    starts, total = [], 0
    for number in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(number, 0)
    start = F.element_at(F.lit(starts or [0]).cast("array<bigint>"), part + 1)
    return written.select(*df.columns, (start + F.col(f"{place} at")).alias(place))
