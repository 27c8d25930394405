"""Parents with and without children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parents_with_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str
) -> DataFrame:
    """Rows of ``parents`` whose key occurs in ``children``. ``parent_key`` is unique."""
    return _match(parents, children, parent_key, child_key, "left_semi")


def parents_without_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str
) -> DataFrame:
    """Rows of ``parents`` whose key does not occur in ``children``. ``parent_key`` is unique."""
    return _match(parents, children, parent_key, child_key, "left_anti")


def _match(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, how: str
) -> DataFrame:
    # Distinct keys leave each map task once per key, so a key that holds most of
    # the children costs no more than any other. The join needs the partitioning
    # that distinct already produced, hence no further shuffle.
    keys = children.select(F.col(child_key).alias("_key")).distinct()
    return parents.join(keys, F.col(parent_key) == F.col("_key"), how)
