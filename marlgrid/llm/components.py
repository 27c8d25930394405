"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.sources.scratch import materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges``.

    ``edges`` has two columns of one orderable type. Edges with a null, loops and repeats do
    no harm. Each round points every node at smaller nodes and writes the result to
    the shared folder; rounds end when nothing changes, after about the logarithm of
    the longest path. A node with very many edges is met by aggregates, which combine
    on the map side, and by joins that adaptive execution can split.
    """
    a, b = (F.col(column) for column in edges.columns)
    links = edges.filter(a != b).select(
        F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")
    )
    links = materialize(links.distinct(), name)
    seen = _summary(links)
    while True:
        links = materialize(_round(links), name)
        now = _summary(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("parent").alias("node"), F.col("parent").alias("component"))
    members = links.select(F.col("child").alias("node"), F.col("parent").alias("component"))
    return members.unionByName(roots.distinct())


def _summary(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first()
    return tuple(row)


def _smallest(links: DataFrame, node: str) -> DataFrame:
    return links.groupBy(F.col("child").alias(node)).agg(F.min("parent").alias("smallest"))


def _round(links: DataFrame) -> DataFrame:
    # Children move from their parents to the smallest parent of those.
    above = _smallest(links, "at")
    moved = (
        links.join(above, links["parent"] == above["at"], "left")
        .select("child", F.coalesce("smallest", "parent").alias("parent"))
        .distinct()
    )
    # A child's parents are linked through the smallest of them.
    own = _smallest(moved, "of")
    joined = moved.join(own, moved["child"] == own["of"]).select("child", "parent", "smallest")
    stars = joined.select("child", F.col("smallest").alias("parent"))
    rest = joined.filter(F.col("parent") != F.col("smallest")).select(
        F.col("parent").alias("child"), F.col("smallest").alias("parent")
    )
    return stars.unionByName(rest).distinct()
