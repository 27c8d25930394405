"""Comparison of two collections of keys, as sets and as multisets.

All of it follows from how many rows each side has per key. One shuffle serves for
that, and it carries at most one row per key and map task, so a key with most of the rows
does no harm. Nulls form one key, as in SQL set operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key of either table, with ``left_rows`` and ``right_rows``."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = left.select(key, one.alias("left_rows"), none.alias("right_rows")).unionByName(
        right.select(key, none.alias("left_rows"), one.alias("right_rows"))
    )
    return both.groupBy(key).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
    )


def side_counts(df: DataFrame, key: str, left: Column, right: Column) -> DataFrame:
    """The same for two sides of one table, which is read once; rows of neither do not count."""
    return (
        df.groupBy(key)
        .agg(F.count_if(left).alias("left_rows"), F.count_if(right).alias("right_rows"))
        .filter("left_rows > 0 OR right_rows > 0")
    )


def union_of(counts: DataFrame, key: str) -> DataFrame:
    """``UNION``: keys of either side, once each."""
    return counts.select(key)


def intersect_of(counts: DataFrame, key: str) -> DataFrame:
    """``INTERSECT``: keys of both sides, once each."""
    return counts.filter("left_rows > 0 AND right_rows > 0").select(key)


def except_of(counts: DataFrame, key: str) -> DataFrame:
    """``EXCEPT``: keys of the left side only, once each."""
    return counts.filter("left_rows > 0 AND right_rows = 0").select(key)


def intersect_all_of(counts: DataFrame, key: str) -> DataFrame:
    """``INTERSECT ALL``, with each key's number of ``copies`` instead of repeated rows."""
    copies = F.least("left_rows", "right_rows").alias("copies")
    return counts.select(key, copies).filter("copies > 0")


def except_all_of(counts: DataFrame, key: str) -> DataFrame:
    """``EXCEPT ALL``, with each key's number of ``copies`` instead of repeated rows."""
    copies = (F.col("left_rows") - F.col("right_rows")).alias("copies")
    return counts.select(key, copies).filter("copies > 0")


def key_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``union_of`` two tables."""
    return union_of(key_counts(left, right, key), key)


def key_intersect(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``intersect_of`` two tables."""
    return intersect_of(key_counts(left, right, key), key)


def key_except(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``except_of`` two tables."""
    return except_of(key_counts(left, right, key), key)


def key_intersect_all(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``intersect_all_of`` two tables."""
    return intersect_all_of(key_counts(left, right, key), key)


def key_except_all(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``except_all_of`` two tables."""
    return except_all_of(key_counts(left, right, key), key)


def key_set_summary(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of keys and rows found on both sides, left only and right only."""
    found = (
        F.when(F.col("right_rows") == 0, "left only")
        .when(F.col("left_rows") == 0, "right only")
        .otherwise("both")
    )
    return (
        key_counts(left, right, key)
        .groupBy(found.alias("found_in"))
        .agg(
            F.count("*").alias("n_keys"),
            F.sum("left_rows").alias("left_rows"),
            F.sum("right_rows").alias("right_rows"),
        )
    )
