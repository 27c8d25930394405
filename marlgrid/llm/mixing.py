"""Mixing of sources to target weights by hierarchical budgets.

Documents hang on a tree: domains, languages within them, sources within those. Every node
has a weight among its siblings. The token budget runs down from the root: siblings
share their parent's budget by weight, a node takes no more than its documents can
give in ``epochs`` passes, and what it cannot take goes to its siblings. Budget that a
whole family cannot take has stayed with the family's own siblings one level up. Each
leaf then takes whole passes over its documents, and of the last pass the longest
prefix, in an order seeded by pass and document, that its budget pays for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlgrid.llm.texts import free_prefix
from marlgrid.sources.scratch import materialize

# Documents, in the mean, among which one task looks for the end of a leaf's prefix.
BUCKET_ROWS = 1_024

# Ten hexadecimal digits of a digest give a document's place.
HASH_RANGE = 1 << 40


class Level(NamedTuple):
    """A level of the tree: its column, weights by name, and the weight of other names."""

    column: str
    weights: Mapping[str, float]
    other: float = 1.0

    def weight(self) -> Column:
        """The weight of a node; a null is a name like any other that has no weight given."""
        weight = F.lit(float(self.other))
        for name, value in self.weights.items():
            weight = F.when(F.col(self.column) == name, float(value)).otherwise(weight)
        return weight


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"of {c}"]) for c in names])


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"of {c}" for c in names})


def share_out(leaves: DataFrame, levels: Sequence[Level], budget: float, epochs: int) -> DataFrame:
    """``leaves`` with the tokens that each is to give, as ``_budget`` (double).

    ``leaves`` has a row per leaf with its ``_held``. Siblings are filled by weight up to
    what they hold: if they are sorted by what they hold per weight, the level to
    which they are filled is the largest of what is left per weight when those before
    are full. That is one running sum per family, over one row per node.
    """
    names = [level.column for level in levels]
    counts = reduce(lambda a, b: a & b, [level.weight() > 0 for level in levels])
    room = F.when(counts, F.col("_held") * epochs).otherwise(0)
    nodes = leaves.select(*names, room.cast("double").alias("_room"))
    total = nodes.agg(F.sum("_room")).first()[0] or 0.0
    above = None
    for depth, level in enumerate(levels):
        path, family = names[: depth + 1], names[:depth]
        own = nodes.groupBy(*path).agg(F.sum("_room").alias("_room"))
        own = own.withColumn("_weight", level.weight())
        if above is None:
            own = own.withColumn("_given", F.lit(float(min(budget, total))))
        else:
            given = _renamed(above.select(*family, F.col("_budget").alias("_given")), family)
            own = own.join(given, _same(own, given, family))
            own = own.select(*path, "_room", "_weight", "_given")
        able = F.col("_room") > 0
        by_need = F.when(able, F.col("_room") / F.col("_weight"))
        siblings = Window.partitionBy(*(family or [F.lit(0)]))
        before = siblings.orderBy(by_need.asc_nulls_first(), *path[-1:]).rowsBetween(
            Window.unboundedPreceding, -1
        )
        weight = F.when(able, F.col("_weight")).otherwise(0.0)
        full = F.coalesce(F.sum("_room").over(before), F.lit(0.0))
        rest = F.sum(weight).over(siblings) - F.coalesce(F.sum(weight).over(before), F.lit(0.0))
        filled = own.withColumn("_fill", F.when(able, (F.col("_given") - full) / rest))
        filled = filled.withColumn("_fill", F.max("_fill").over(siblings))
        share = F.when(able, F.least(F.col("_room"), F.col("_fill") * F.col("_weight")))
        share = F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0))
        above = materialize(filled.select(*path, share.alias("_budget")), "node-budgets")
    result = _renamed(above, names)
    return leaves.join(result, _same(leaves, result, names)).select(*leaves.columns, "_budget")


def _placed(rows: DataFrame, seed: int, prefix: str = "_") -> DataFrame:
    """Adds a row's place in its leaf's last pass, and the bucket of the leaf that holds it."""
    parts = [F.lit(str(seed)), *(F.col(prefix + c).cast("string") for c in ("passes", "key"))]
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    rows = rows.withColumn(
        f"{prefix}place", F.conv(F.substring(digest, 1, 10), 16, 10).cast("bigint")
    )
    bucket = F.floor(F.col(f"{prefix}place") * F.col(f"{prefix}buckets") / F.lit(float(HASH_RANGE)))
    return rows.withColumn(f"{prefix}bucket", bucket)


def _borders(narrow: DataFrame, plan: DataFrame, names: list[str], seed: int) -> DataFrame:
    """``plan`` with what ends each leaf's prefix: the bucket, and in it the document.

    Buckets before ``_border`` are taken whole, those behind it not at all. In it, rows up to
    ``_end`` (place, key and tokens) are taken, and ``_some`` of the ``_all`` rows like that.
    """
    of = _renamed(plan, names)
    placed = _placed(narrow.join(of, _same(narrow, of, names)).drop(*[f"of {c}" for c in names]), seed)
    sums = placed.groupBy(*names, "_bucket").agg(
        F.sum("_n").alias("_sum"), F.first("_rest").alias("_rest")
    )
    so_far = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = sums.withColumn("_upto", F.sum("_sum").over(so_far)).filter(F.col("_upto") > F.col("_rest"))
    border = sums.groupBy(*names).agg(
        F.min("_bucket").alias("_border"),
        F.min_by(F.col("_rest") - F.col("_upto") + F.col("_sum"), "_bucket").alias("_left"),
    )
    border = materialize(border, "borders")
    # Rows that are alike are one here, however many.
    at = _renamed(border, names)
    mine = placed.join(at, _same(placed, at, names)).drop(*[f"of {c}" for c in names])
    alike = (
        mine.filter((F.col("_bucket") == F.col("_border")) & (F.col("_rest") > 0))
        .groupBy(*names, "_place", "_key", "_n")
        .agg(F.count("*").alias("_all"), F.first("_left").alias("_left"))
    )
    before = Window.partitionBy(*names).orderBy("_place", "_key", "_n").rowsBetween(
        Window.unboundedPreceding, -1
    )
    room = F.col("_left") - F.coalesce(F.sum(F.col("_all") * F.col("_n")).over(before), F.lit(0))
    taken = (
        alike.withColumn("_room", room)
        .filter(F.col("_room") >= 0)
        .withColumn("_fit", F.when(F.col("_n") > 0, F.floor(F.col("_room") / F.col("_n"))))
        .withColumn("_some", F.coalesce(F.least("_all", "_fit"), "_all"))
        .filter("_some > 0")
    )
    last = F.max(F.struct(F.struct("_place", "_key", "_n").alias("_end"), "_some", "_all"))
    ends = _renamed(taken.groupBy(*names).agg(last.alias("_last")), names)
    found = plan.join(at.drop("_left"), _same(plan, at, names), "left")
    found = found.drop(*[f"of {c}" for c in names])
    found = found.join(ends, _same(found, ends, names), "left")
    whole = F.when(F.col("_rest") > 0, F.coalesce("_border", F.col("_buckets"))).otherwise(-1)
    return found.select(*plan.columns, whole.cast("bigint").alias("_border"), "_last.*")


def mix(
    docs: DataFrame,
    levels: Sequence[Level],
    share: float,
    epochs: int,
    seed: int,
    key: str = "doc_id",
    tokens: str = "n_tokens",
    copies: str = "copies",
) -> DataFrame:
    """Adds ``copies`` to every row of ``docs``: how often the mixture takes it.

    The budget is ``share`` of all ``tokens``; a leaf is passed over up to ``epochs`` times.
    A leaf never takes more than its budget. Null names are nodes of their own; null
    or negative tokens count as none. Ties in the seeded order go by ``key``, then by tokens;
    repeated rows are documents of their own, and if some of them are taken, it is any.
    A column called as ``copies`` is replaced, all others are kept. An empty table stays
    empty.

    A leaf may hold any part of the documents: it is cut into buckets of the seeded
    order, whose sums are combined on the map side. Only the bucket that the prefix ends
    in is put in order, by key and tokens alone. The rows of ``docs`` then meet one row per
    leaf, and move only if there are too many leaves to broadcast.
    """
    names = [f"level {i}" for i in range(len(levels))]
    docs = docs.drop(copies)
    amount = F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0)).cast("bigint")
    narrow = docs.select(
        *[F.col(level.column).alias(name) for level, name in zip(levels, names, strict=True)],
        F.col(key).alias("_key"),
        amount.alias("_n"),
    )
    narrow = materialize(narrow, "documents-to-mix")
    leaves = narrow.groupBy(*names).agg(F.sum("_n").alias("_held"), F.count("*").alias("_rows"))
    leaves = materialize(leaves, "leaves")
    total = leaves.agg(F.sum("_held")).first()[0] or 0
    inner = [level._replace(column=name) for level, name in zip(levels, names, strict=True)]
    budgets = share_out(leaves, inner, total * share, epochs)
    # A hair more, so that a budget that is a whole number does not lose its last token.
    whole = F.floor(F.col("_budget") + 1e-6)
    passes = F.when(F.col("_held") > 0, F.floor(whole / F.col("_held"))).otherwise(0)
    plan = budgets.select(
        *names,
        passes.cast("bigint").alias("_passes"),
        (whole - passes * F.col("_held")).cast("bigint").alias("_rest"),
        F.ceil(F.col("_rows") / BUCKET_ROWS).alias("_buckets"),
    )
    plan = materialize(plan, "leaf-plans")
    plan = materialize(_borders(narrow, plan, names, seed), "leaf-ends")

    prefix = free_prefix([*docs.columns, copies])
    plan = plan.withColumnsRenamed({c: f"{prefix}{c.removeprefix('_')}" for c in plan.columns})
    met = [
        docs[level.column].eqNullSafe(plan[f"{prefix}{name}"])
        for level, name in zip(levels, names, strict=True)
    ]
    rows = docs.join(plan, reduce(lambda a, b: a & b, met))
    rows = rows.withColumns({f"{prefix}key": F.col(key), f"{prefix}n": amount})
    rows = _placed(rows, seed, prefix)
    own = {c: F.col(f"{prefix}{c}") for c in ("bucket", "border", "passes", "end", "some", "all")}
    at = F.struct(*[F.col(f"{prefix}{c}").alias(f"_{c}") for c in ("place", "key", "n")])
    here = (own["bucket"] == own["border"]) & own["end"].isNotNull()
    taken = (own["bucket"] < own["border"]) | (here & (at <= own["end"]))
    copied = (own["passes"] + F.when(taken, 1).otherwise(0)).cast("bigint").alias(copies)
    torn = here & (at <= own["end"]) & (at >= own["end"]) & (own["some"] < own["all"])
    torn = F.coalesce(torn, F.lit(False))
    if plan.filter(F.col(f"{prefix}some") < F.col(f"{prefix}all")).isEmpty():
        return rows.select(*docs.columns, copied)
    # Of rows that are alike only some are taken: they are counted off, part by part.
    alike = rows.filter(torn).withColumn(f"{prefix}part", F.spark_partition_id())
    alike = materialize(alike, "torn-rows")
    leaf = [f"{prefix}{name}" for name in names]
    part = f"{prefix}part"
    counts = alike.groupBy(*leaf, part).agg(F.count("*").alias(f"{prefix}count"))
    earlier = Window.partitionBy(*leaf).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(f"{prefix}count").over(earlier), F.lit(0)).alias(f"{prefix}start")
    on = [*leaf, part]
    counts = _renamed(counts.select(*on, start), on)
    within = F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(0)))
    alike = alike.withColumn(f"{prefix}at", within)
    alike = alike.join(counts, _same(alike, counts, on))
    some = F.col(f"{prefix}start") + F.col(f"{prefix}at") <= own["some"]
    counted = (own["passes"] + F.when(some, 1).otherwise(0)).cast("bigint").alias(copies)
    return rows.filter(~torn).select(*docs.columns, copied).unionByName(
        alike.select(*docs.columns, counted)
    )
