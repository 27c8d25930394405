"""Vectors that are near in cosine, by an epsilon grid order join.

Vectors are brought to unit length, where a cosine of at least ``least`` is a distance of
at most epsilon. They are sorted by the cells, epsilon wide, of a grid over the leading
principal dimensions. The sequence is cut into intervals; two intervals meet in a task
unless their boxes in those dimensions are provably further apart than epsilon. The
task joins them recursively: it halves the longer interval, skips pairs of parts that
are provably distant, and compares what is left by matrix products.

A task gives back the number of links of each vector and a forest that connects what is
linked, never the links themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from marlgrid.llm.components import connected_components
from marlgrid.sources.scratch import materialize

# Principal dimensions of the grid, and vectors that they are computed from.
DIMENSIONS = 8
SAMPLE = 8_192

# Dimensions whose cells intervals are matched on.
MET = 3

# Vectors of an interval, and of a part that is compared as a whole.
INTERVAL = 8_192
LEAF = 512

# Rounding of a product of unit vectors in single precision stays below this.
SINGLE = 1e-4


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The rows in double precision, brought to unit length."""
    vectors = vectors.astype(np.float64)
    # A scale of its own keeps the squares of very large and very small numbers finite.
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, filled with zeros to ``width``, and their own lengths."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = array.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = array.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width), sizes
    rows = np.zeros((len(sizes), width), flat.dtype)
    rows[np.arange(width) < sizes[:, None]] = flat
    return rows, sizes


class TileJoin:
    """Links between the vectors of two intervals, or of one with itself."""

    def __init__(self, units: np.ndarray, sizes: np.ndarray, copies: np.ndarray, basis, least):
        self.units = units
        self.single = units.astype(np.float32)
        self.sizes = sizes if len(np.unique(sizes)) > 1 else None
        self.copies = copies.astype(np.float64)
        self.least = least
        self.reach = 2 - 2 * least + 1e-9
        projected = units @ basis
        rest = np.sqrt(np.maximum(0.0, 1 - (projected * projected).sum(axis=1)))
        # The distance in these coordinates is at most the distance of the vectors.
        self.points = np.column_stack([projected, rest])
        self.links = np.zeros(len(units))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        # Pairs of vectors that were compared.
        self.compared = 0

    def distant(self, a: slice, b: slice) -> bool:
        left, right = self.points[a], self.points[b]
        gap = np.maximum(left.min(0) - right.max(0), right.min(0) - left.max(0))
        gap = np.maximum(gap, 0.0)
        return float(gap @ gap) > self.reach

    def join(self, a: slice, b: slice) -> None:
        """Joins part ``a`` with part ``b``, which is the same or comes after it."""
        n, m = a.stop - a.start, b.stop - b.start
        same = a == b
        if n == 0 or m == 0 or (not same and self.distant(a, b)):
            return
        if max(n, m) <= LEAF:
            self.compare(a, b, same)
        elif same:
            one, two = _halves(a)
            self.join(one, one)
            self.join(one, two)
            self.join(two, two)
        elif n >= m:
            for half in _halves(a):
                self.join(half, b)
        else:
            for half in _halves(b):
                self.join(a, half)

    def compare(self, a: slice, b: slice, same: bool) -> None:
        self.compared += (a.stop - a.start) * (b.stop - b.start)
        near = self.single[a] @ self.single[b].T >= self.least - SINGLE
        if same:
            np.fill_diagonal(near, False)
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            return
        left, right = rows + a.start, columns + b.start
        linked = self.units[left] @ self.units[right].T >= self.least
        if same:
            linked &= left[:, None] != right
        if self.sizes is not None:
            linked &= self.sizes[left][:, None] == self.sizes[right]
        self.links[left] += linked @ self.copies[right]
        if not same:
            self.links[right] += self.copies[left] @ linked
        self.connect(left, right, linked)

    def connect(self, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> None:
        """Adds edges from every linked vector to the first of its component in this part."""
        far = np.iinfo(np.int64).max
        of_left, of_right = left.copy(), right.copy()
        while True:
            to_right = np.minimum(of_right, np.where(linked, of_left[:, None], far).min(axis=0))
            to_left = np.minimum(of_left, np.where(linked, to_right, far).min(axis=1))
            if (to_left == of_left).all() and (to_right == of_right).all():
                break
            of_left, of_right = to_left, to_right
        self.edges += [(left, of_left), (right, of_right)]

    def forest(self) -> np.ndarray:
        """For each vector the first one that it is connected with in this tile."""
        root = np.arange(len(self.units))
        if not self.edges:
            return root
        one = np.concatenate([edge[0] for edge in self.edges])
        two = np.concatenate([edge[1] for edge in self.edges])
        while True:
            low = np.minimum(root[one], root[two])
            before = root.copy()
            np.minimum.at(root, root[one], low)
            np.minimum.at(root, root[two], low)
            while (root[root] != root).any():
                root = root[root]
            if (root == before).all():
                return root


def _halves(part: slice) -> tuple[slice, slice]:
    middle = (part.start + part.stop) // 2
    return slice(part.start, middle), slice(middle, part.stop)


def principal_axes(sample: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """An orthonormal basis of the leading principal dimensions, one per column."""
    moved = sample - sample.mean(axis=0)
    _, vectors = np.linalg.eigh(moved.T @ moved)
    return vectors[:, ::-1][:, :dimensions]


def _usable(vector: str) -> F.Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.col(vector).isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9
) -> DataFrame:
    """One row per row of ``vectors``: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Two rows are linked if the cosine of their vectors, in double precision, is at least
    ``least``. ``n_links`` counts the other rows linked with a row, ``component_id`` is the
    smallest key that links lead to, ``kept`` tells whether it is the row's own.
    Vectors that are null, empty, zero, or hold a null or a number that is not finite
    have no links, nor have vectors of different length with each other. Exact copies,
    however many, stand for one vector in the join. Repeated rows count each. Other columns
    are dropped. An empty table gives no rows.

    What boxes rule out depends on the vectors: if they have few leading dimensions, nearly
    all pairs; if all dimensions vary alike, none, and work grows with their square.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    usable = _usable("_vector")
    # 128 bits of hash stand for a vector where rows are matched.
    rows = rows.select(
        "_key",
        "_vector",
        F.when(usable, F.xxhash64(F.lit(1), "_vector")).alias("_h1"),
        F.when(usable, F.xxhash64(F.lit(2), "_vector")).alias("_h2"),
    )
    distinct = (
        rows.filter(F.col("_h1").isNotNull())
        .groupBy("_h1", "_h2")
        .agg(
            F.first("_vector").alias("_vector"),
            F.count("*").alias("_copies"),
            F.min("_key").alias("_first_key"),
        )
    )
    distinct = materialize(distinct, "distinct-vectors")
    n, width = distinct.agg(F.count("*"), F.max(F.size("_vector"))).first()
    nodes = None
    if n:
        basis = _basis(distinct, n, width)
        nodes = _order(distinct, basis, width, least)
        nodes = _linked(nodes, basis, width, least)
    if nodes is None:
        nodes = spark.createDataFrame(
            [], "_h1 bigint, _h2 bigint, _links bigint, _component bigint"
        ).withColumn("_component", F.col("_component").cast(vectors.schema[key].dataType))
    component = F.coalesce("_component", "_key")
    return rows.drop("_vector").join(nodes, ["_h1", "_h2"], "left").select(
        F.col("_key").alias(key),
        F.coalesce("_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("_key")).alias("kept"),
    )


def _basis(distinct: DataFrame, n: int, width: int) -> np.ndarray:
    drawn = F.pmod(F.xxhash64("_h1", "_h2"), F.lit(n)) < SAMPLE
    sample = distinct.filter(drawn).select("_vector").toArrow()
    if sample.num_rows == 0:
        return np.eye(width, min(width, DIMENSIONS))
    return principal_axes(unit_rows(_matrix(sample.column("_vector"), width)[0]))


def _order(distinct: DataFrame, basis: np.ndarray, width: int, least: float) -> DataFrame:
    """The vectors in grid order, with ``node`` (place in the sequence) and ``interval``."""
    cell = math.sqrt(2 - 2 * least) * (1 + 1e-9)
    schema = StructType([*distinct.schema, StructField("_cells", ArrayType(IntegerType()))])

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(batch.schema.get_field_index("_vector")), width)[0]
                found = np.floor(unit_rows(vectors) @ basis / cell).astype(np.int32)
                column = pa.array(list(found), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, column], names=[*batch.schema.names, "_cells"]
                )

    placed = distinct.mapInArrow(cells, schema)
    order = ["_cells", "_h1", "_h2"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    # Places within the sorted partitions are fixed by writing them down.
    placed = materialize(
        placed.withColumn("_part", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "ordered-vectors",
    )
    counts = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    starts, total = [], 0
    for part in range(max(counts) + 1):
        starts.append(total)
        total += counts.get(part, 0)
    start = F.element_at(F.lit(starts).cast("array<bigint>"), F.col("_part") + 1)
    return placed.withColumn("_node", start + F.col("_at")).withColumn(
        "_interval", F.floor(F.col("_node") / F.lit(INTERVAL))
    )


def _tiles(nodes: DataFrame) -> DataFrame:
    """Pairs of intervals that may hold linked vectors, as ``_one`` <= ``_two``.

    Linked vectors lie in the same or in adjacent cells of every dimension. Intervals
    meet where one has vectors in a cell of the first ``MET`` dimensions and the other in
    the same or an adjacent one, and are kept if their boxes of cells are adjacent in
    the others.
    """
    dimensions = len(nodes.select("_cells").first()["_cells"])
    low = [F.min(F.col("_cells")[i]) for i in range(dimensions)]
    high = [F.max(F.col("_cells")[i]) for i in range(dimensions)]
    boxes = nodes.groupBy("_interval").agg(F.array(*low).alias("low"), F.array(*high).alias("high"))
    boxes = materialize(boxes, "intervals")
    met = range(min(MET, dimensions))
    held = nodes.select("_interval", *[F.col("_cells")[i].alias(f"c{i}") for i in met]).distinct()
    held = materialize(held, "interval-cells")
    near = held
    for i in met:
        steps = F.explode(F.array(F.col(f"c{i}") - 1, F.col(f"c{i}"), F.col(f"c{i}") + 1))
        near = near.withColumn(f"c{i}", steps)
    one = near.withColumnRenamed("_interval", "_one")
    two = held.withColumnRenamed("_interval", "_two")
    pairs = one.join(two, [f"c{i}" for i in met]).filter("_one <= _two").select("_one", "_two").distinct()
    box = lambda name, side: boxes.select(
        F.col("_interval").alias(name), F.struct("low", "high").alias(side)
    )
    apart = F.exists(
        F.zip_with(
            F.arrays_zip("a.low", "a.high"),
            F.arrays_zip("b.low", "b.high"),
            lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"]),
        ),
        lambda gap: gap > 1,
    )
    both = pairs.join(box("_one", "a"), "_one").join(box("_two", "b"), "_two")
    return both.filter(~apart).select("_one", "_two")


def _linked(nodes: DataFrame, basis: np.ndarray, width: int, least: float) -> DataFrame:
    """``_links`` and ``_component`` (smallest key) of each distinct vector."""
    tiles = materialize(_tiles(nodes), "tiles")
    sent = nodes.select("_interval", "_node", "_vector", "_copies")
    # Both intervals of a tile; a task gets two times INTERVAL rows at most.
    meant = tiles.select("_one", "_two", F.explode(F.array_distinct(F.array("_one", "_two"))))
    sent = sent.join(meant.withColumnRenamed("col", "_interval"), "_interval")

    def run(table: pa.Table) -> pa.Table:
        vectors, sizes = _matrix(table.column("_vector"), width)
        ids = table.column("_node").to_numpy()
        # Back into grid order, which a shuffle does not keep.
        order = np.argsort(ids)
        ids = ids[order]
        copies = table.column("_copies").to_numpy()[order]
        tile = TileJoin(unit_rows(vectors[order]), sizes[order], copies, basis, least)
        first, last = table.column("_one")[0].as_py(), table.column("_two")[0].as_py()
        border = int((table.column("_interval").to_numpy() == first).sum())
        if first == last:
            tile.join(slice(0, border), slice(0, border))
        else:
            tile.join(slice(0, border), slice(border, len(ids)))
        found = np.flatnonzero(tile.links > 0)
        roots = tile.forest()[found]
        return pa.table(
            {
                "_node": pa.array(ids[found], pa.int64()),
                "_links": pa.array(tile.links[found].astype(np.int64), pa.int64()),
                "_root": pa.array(ids[roots], pa.int64()),
            }
        )

    found = sent.groupBy("_one", "_two").applyInArrow(
        run, "_node bigint, _links bigint, _root bigint"
    )
    found = materialize(found, "tile-links")
    links = found.groupBy("_node").agg(F.sum("_links").alias("_far"))
    components = connected_components(found.select("_node", "_root"), "vector-components")
    whole = (
        nodes.select("_node", "_h1", "_h2", "_copies", "_first_key")
        .join(links, "_node", "left")
        .join(components.withColumnRenamed("node", "_node"), "_node", "left")
        .select(
            "_h1",
            "_h2",
            "_first_key",
            (F.coalesce("_far", F.lit(0)) + F.col("_copies") - 1).alias("_links"),
            F.coalesce("component", "_node").alias("_root"),
        )
    )
    whole = materialize(whole, "linked-vectors")
    smallest = whole.groupBy("_root").agg(F.min("_first_key").alias("_component"))
    return whole.join(smallest, "_root").select("_h1", "_h2", "_links", "_component")
