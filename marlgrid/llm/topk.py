"""Exact search for the largest inner products, by buckets of vectors of like length.

The vectors searched are sorted by falling length and cut into buckets. A query meets the
buckets in that order, in rounds of which each has as many as all before it. Once
it has found enough, its least score so far is a threshold: divided by the lengths of
the query and of a bucket's longest vector it gives the cosine that a vector of the bucket
must reach. Above 1 the bucket holds nothing for it, nor does any later one; a query
that is done with all that is left takes no part in further rounds. Else a bucket is
pruned in one of two ways, whichever leaves less to compute at its local thresholds:
by length, as only the longer vectors of the bucket can reach the threshold, or by
coordinates, as a vector at that cosine must lie within a range of the query in each
coordinate. What is left is verified by whole products in integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlgrid.llm.order import numbered
from marlgrid.sources.scratch import materialize

# Vectors of a bucket, and queries that meet it in one task.
BUCKET = 8_192
QUERY_BLOCK = 8_192
# Queries whose products are taken together.
CHUNK = 256

# Coordinates that a query is looked up by, its largest; and what a product costs
# there, in products of a matrix.
FOCUS = 3
LOOKUP_COST = 8

# A component of this size or more, once scaled, counts as not finite; products of what is
# left fit 64 bits.
MOST = 1 << 24
# Rounding of a cosine.
HAIR = 1e-9
# The threshold of a query that takes any score.
NO_LEAST = -(2**63)


class Bucket:
    """Vectors of like length, longest first, that queries are held against."""

    def __init__(self, x: np.ndarray, square: np.ndarray, order: np.ndarray, most: int):
        self.x = x
        self.length = np.sqrt(square.astype(np.float64))
        # The place of each vector's key among all keys: ties go to the first.
        self.order = order
        self.most = most
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.compared = 0

    def coordinate(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The vectors in order of a coordinate of theirs at unit length, and that coordinate."""
        if i not in self.sorted:
            values = self.x[:, i] / np.maximum(self.length, 1e-300)
            order = np.argsort(values, kind="stable")
            self.sorted[i] = order, values[order]
        return self.sorted[i]

    def search(self, q: np.ndarray, square: np.ndarray, least: np.ndarray) -> tuple:
        """Query number, vector number and score of what may be among the ``most`` best.

        ``least`` is the score that a query looks for at least, ``NO_LEAST`` for any.
        """
        length = np.sqrt(square.astype(np.float64))
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(least > 0, least / length, 0.0)
            cosine = np.where(least > 0, needed / self.length[0], -1.0)
        prefix = np.searchsorted(-self.length, -needed * (1 - HAIR), side="right")
        prefix = np.where(least > 0, prefix, len(self.x))
        alive = np.flatnonzero((cosine <= 1 + HAIR) & (prefix > 0))
        if not len(alive):
            return (np.zeros(0, np.int64),) * 3
        ranges = self.ranges(q[alive], length[alive], cosine[alive])
        looked_up = np.minimum(ranges[2].min(axis=1), prefix[alive]).sum() * LOOKUP_COST
        if looked_up < prefix[alive].sum():
            return self.by_coordinates(q, least, alive, prefix, ranges)
        return self.by_length(q, length, least, alive, prefix)

    def ranges(self, q: np.ndarray, length: np.ndarray, cosine: np.ndarray) -> tuple:
        """For each query its focus coordinates, their ranges' starts, and their sizes."""
        focus = np.argsort(-np.abs(q), axis=1, kind="stable")[:, :FOCUS]
        unit = np.take_along_axis(q, focus, axis=1) / np.maximum(length, 1e-300)[:, None]
        t = np.clip(cosine - HAIR, -1, 1)[:, None]
        reach = np.sqrt((1 - t * t) * np.maximum(0.0, 1 - unit * unit))
        low = np.where(unit < -t, -1.0, unit * t - reach) - HAIR
        high = np.where(unit > t, 1.0, unit * t + reach) + HAIR
        start, stop = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for i in np.unique(focus):
            mine = focus == i
            values = self.coordinate(int(i))[1]
            start[mine] = np.searchsorted(values, low[mine], "left")
            stop[mine] = np.searchsorted(values, high[mine], "right")
        return focus, start, np.maximum(stop - start, 0)

    def by_coordinates(self, q, least, alive, prefix, ranges) -> tuple:
        """Looks up the vectors that lie in a query's ranges, and multiplies those."""
        found = []
        for row, (focus, start, size) in zip(alive, zip(*ranges, strict=True), strict=True):
            near: np.ndarray | None = None
            for j in np.argsort(size, kind="stable"):
                order = self.coordinate(int(focus[j]))[0]
                mine = order[start[j] : start[j] + size[j]]
                # The further ranges only if they cost less than the products they save.
                if near is None:
                    near = mine[mine < prefix[row]]
                elif size[j] <= 4 * len(near):
                    near = np.intersect1d(near, mine, assume_unique=True)
            score = _products(q[row : row + 1], self.x[near])[0]
            self.compared += len(near)
            kept = np.flatnonzero(score >= least[row])
            best = kept[np.lexsort((self.order[near[kept]], -score[kept]))[: self.most]]
            found.append((np.full(len(best), row), near[best], score[best]))
        return tuple(np.concatenate(values) for values in zip(*found, strict=True))

    def by_length(self, q, length, least, alive, prefix) -> tuple:
        """Multiplies each query with the vectors that are long enough for it."""
        alive = alive[np.argsort(prefix[alive], kind="stable")]
        found = []
        for i in range(0, len(alive), CHUNK):
            rows = alive[i : i + CHUNK]
            n = int(prefix[rows].max())
            score = _products(q[rows], self.x[:n])
            self.compared += score.size
            cut = least[rows]
            if n > self.most:
                cut = np.maximum(cut, np.partition(score, n - self.most, axis=1)[:, n - self.most])
            row, column = np.nonzero(score >= cut[:, None])
            value = score[row, column]
            order = np.lexsort((self.order[column], -value, row))
            row, column, value = row[order], column[order], value[order]
            place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
            best = place < self.most
            found.append((rows[row[best]], column[best], value[best]))
        return tuple(np.concatenate(values) for values in zip(*found, strict=True))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of all rows of two matrices of whole numbers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    array = column.combine_chunks()
    sizes = array.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.zeros((len(sizes), width), np.int64)
    rows[np.arange(width) < sizes[:, None]] = array.flatten().to_numpy(zero_copy_only=False)
    return rows


def _scaled(vectors: DataFrame, asks: Column, key: str, vector: str, scale: int) -> DataFrame:
    """Distinct ``_key`` and whole numbers ``_x`` of usable rows, their square length and hashes."""
    fits = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < MOST)
    )
    usable = vectors.filter(F.col(vector).isNotNull() & fits)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("int"))
    rows = usable.select(
        F.col(key).alias("_key"), x.alias("_x"), F.coalesce(asks, F.lit(False)).alias("_asks")
    )
    square = F.aggregate("_x", F.lit(0).cast("bigint"), lambda t, c: t + c.cast("bigint") * c)
    # 128 bits of hash stand for a vector where rows are matched.
    rows = rows.withColumns(
        {"_square": square, "_h1": F.xxhash64(F.lit(1), "_x"), "_h2": F.xxhash64(F.lit(2), "_x")}
    )
    return rows.groupBy("_key", "_h1", "_h2").agg(
        F.first("_x").alias("_x"),
        F.first("_square").alias("_square"),
        F.max("_asks").alias("_asks"),
    )


def _met(searched: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    """What each task finds for a block of queries in a bucket: ``_number``, a key, hashes, a score."""
    kind = searched.schema["_key"].dataType.simpleString()

    def run(bucket: pa.Table, block: pa.Table) -> pa.Table:
        # A shuffle does not keep the order.
        bucket = bucket.sort_by([("_place", "ascending")])
        keys = bucket.column("_key").combine_chunks()
        order = np.empty(len(keys), np.int64)
        order[pc.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
        number = block.column("_number").to_numpy()
        rows = row, column, score = (np.zeros(0, np.int64),) * 3
        if bucket.num_rows and block.num_rows:
            square = bucket.column("_square").to_numpy()
            held = Bucket(_matrix(bucket.column("_x"), width), square, order, k)
            least = pc.fill_null(block.column("_least"), NO_LEAST).to_numpy()
            q = _matrix(block.column("_x"), width)
            rows = row, column, score = held.search(q, block.column("_square").to_numpy(), least)
        found = bucket.take(pa.array(column)) if len(rows[0]) else bucket.slice(0, 0)
        return pa.table(
            {
                "_number": pa.array(number[row] if len(row) else row, pa.int64()),
                "_key": found.column("_key"),
                "_h1": found.column("_h1"),
                "_h2": found.column("_h2"),
                "_score": pa.array(score, pa.int64()),
            }
        )

    met = searched.groupBy("_bucket", "_block").cogroup(queries.groupBy("_bucket", "_block"))
    return met.applyInArrow(
        run, f"_number bigint, _key {kind}, _h1 bigint, _h2 bigint, _score bigint"
    )


def _first(rows: DataFrame, by: list[str], k: int, rank: str) -> DataFrame:
    """The ``k`` best rows of each group, by falling score and rising key."""
    order = [F.desc("_score"), F.asc_nulls_last("_key"), "_h1", "_h2"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(rank, place).filter(F.col(rank) <= k)


def top_products(
    vectors: DataFrame,
    asks: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """The ``k`` highest scores of each query: ``query_id``, ``rank`` (from 1), ``key``, ``score``.

    Components are multiplied by ``scale`` and rounded down; a score is the inner product
    of such vectors. Rows of which ``asks`` is true are queries; every row but the query's
    own is searched. Ties go to the smaller key, a null key comes last. A query has fewer
    rows if there are fewer vectors.

    Vectors that are null, or hold a null or a number that is not finite, or once scaled
    is ``MOST`` or more, take no part. Missing components of a shorter vector count as zeros.
    Rows that repeat a key and a vector are one; several vectors under one key are
    a query and a vector searched each. Other columns play no part. An empty table gives
    no rows.

    Of equal vectors those with the ``k`` + 1 smallest keys are searched, as no other can be
    among a query's best; equal queries are searched for once.
    """
    rows = materialize(_scaled(vectors, asks, key, vector, scale), "scaled-vectors")
    same = Window.partitionBy("_h1", "_h2").orderBy(F.asc_nulls_last("_key"))
    searched = rows.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k + 1)
    searched = searched.drop("_copy", "_asks")
    # Equal vectors stay neighbours, and nulls last, whatever the partitions.
    order = [F.desc("_square"), "_h1", "_h2", F.asc_nulls_last("_key")]
    searched = numbered(searched, order, "_place", "searched-vectors").withColumn(
        "_bucket", F.floor(F.col("_place") / F.lit(BUCKET))
    )
    queries = (
        rows.filter("_asks")
        .groupBy("_h1", "_h2")
        .agg(F.first("_x").alias("_x"), F.first("_square").alias("_square"))
        .withColumn("_number", F.monotonically_increasing_id())
    )
    queries = materialize(queries, "distinct-queries")
    facts = searched.agg(F.count("*"), F.max(F.size("_x"))).first()
    total, width = facts[0], max(1, facts[1] or 0)
    buckets = math.ceil(total / BUCKET)
    # Rounds of 1, 1, 2, 4 and more buckets, and the square of the longest vector in each.
    starts = [0, *(1 << i for i in range(max(0, buckets - 1).bit_length()))]
    longest = searched.filter(F.col("_place").isin([BUCKET * start for start in starts]))
    tops = {r["_bucket"]: r["_square"] for r in longest.select("_bucket", "_square").collect()}
    found = None
    for start, stop in zip(starts, [*starts[1:], buckets], strict=True):
        if start >= buckets:
            break
        active = queries.withColumn("_least", F.lit(None).cast("bigint"))
        if found is not None:
            # With fewer than k + 1 vectors found, nothing is known of the others.
            least = found.groupBy(F.col("_number").alias("_of")).agg(
                F.when(F.count("*") > k, F.min("_score")).alias("_least")
            )
            active = queries.join(least, F.col("_number") == F.col("_of"), "left").drop("_of")
            wanted = F.col("_least").cast("double")
            most = F.col("_square").cast("double") * float(tops[start]) * (1 + HAIR)
            open_ = F.col("_least").isNull() | (wanted <= 0) | (wanted * wanted <= most)
            active = materialize(active.filter(open_), "open-queries")
        n = active.count()
        if not n:
            break
        blocks = math.ceil(n / QUERY_BLOCK)
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
        mine = F.pmod(F.xxhash64("_number", F.lit(start)), F.lit(blocks).cast("bigint"))
        theirs = F.sequence(F.lit(start).cast("bigint"), F.lit(stop - 1).cast("bigint"))
        met = _met(
            searched.filter(F.col("_bucket").between(start, stop - 1)).withColumn(
                "_block", F.explode(every)
            ),
            active.withColumns({"_block": mine, "_bucket": F.explode(theirs)}),
            k + 1,
            width,
        )
        met = met if found is None else met.unionByName(found)
        found = materialize(_first(met, ["_number"], k + 1, "_rank").drop("_rank"), "best-so-far")
    asked = rows.filter("_asks").select(
        F.col("_key").alias("_query"), F.col("_h1").alias("_q1"), F.col("_h2").alias("_q2")
    )
    if found is None:
        kind = vectors.schema[key].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"query_id {kind}, rank int, `{key}` {kind}, score bigint"
        )
    named = queries.select("_number", F.col("_h1").alias("_q1"), F.col("_h2").alias("_q2"))
    given = asked.join(named, ["_q1", "_q2"]).join(found, "_number")
    same = F.col("_h1").eqNullSafe(F.col("_q1")) & F.col("_h2").eqNullSafe(F.col("_q2"))
    others = given.filter(~(same & F.col("_key").eqNullSafe(F.col("_query"))))
    best = _first(others, ["_query", "_q1", "_q2"], k, "rank")
    return best.select(
        F.col("_query").alias("query_id"),
        "rank",
        F.col("_key").alias(key),
        F.col("_score").alias("score"),
    )
