"""Whitening of vectors: leading principal components, each brought to unit variance.

Two passes over the vectors give their sums and the scatter of their deviations from the
mean; both are added up per dimension and per pair of dimensions, so that a task passes
on no more than that, and the driver gets one matrix. Its eigenvectors are found by
spectral divide and conquer: the polar factor of the matrix less a shift, by QDWH
iterations (dynamically weighted Halley steps, each a QR decomposition), has the
eigenvalues 1 and -1, hence gives the projectors on the invariant subspaces above and
below the shift. Either subspace is split on, down to single components. The matrix of
the leading ones is shipped to the tasks, which whiten each vector where it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.sources.scratch import materialize

# Entries are scaled, rounded down and moved.
SCALE, MOVED = 1024, 100_000
COMPONENTS = 8

# An entry of this size or more has no whole number and counts as not finite.
MOST = 2.0**52
# A component of less variance than this part of the largest is rounding, not variance.
LEAST_SHARE = 1e-10
# Vectors whose deviations are multiplied together.
BLOCK = 4_096

_LOW = (1 << 32) - 1
_LIMB = 21


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by QDWH."""
    m = len(a)
    x = a / max(float(np.linalg.norm(a)), np.finfo(float).tiny)
    low = np.finfo(float).eps
    eye = np.eye(m)
    for _ in range(40):
        square = low * low
        root = (4 * (1 - square) / (square * square)) ** (1 / 3)
        first = np.sqrt(1 + root)
        weight = first + 0.5 * np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * first))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        moved = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:m] @ q[m:].T)
        moved = (moved + moved.T) / 2
        change = np.linalg.norm(moved - x)
        x = moved
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        if change < 1e-14 * m and 1 - low < 1e-14:
            break
    return x


def _split(a: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below some shift.

    A shift next to an eigenvalue gives bad projectors. Of several shifts the first is
    taken that leaves no more than ``tiny`` between the subspaces, or else the best.
    """
    m = len(a)
    mean = np.trace(a) / m
    spread = float(np.linalg.norm(a - mean * np.eye(m))) / np.sqrt(m)
    # The mean lies within the spectrum; the median of the diagonal halves it better.
    shifts = [float(np.median(np.diag(a))), mean]
    shifts += [mean + t * spread for t in (0.1, -0.1, 0.3, -0.3, 0.03, -0.03, 0.6, -0.6)]
    best, least = None, np.inf
    for shift in shifts:
        projector = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < m:
            continue
        start = np.random.default_rng(m).normal(size=(m, k))
        basis, _ = np.linalg.qr(projector @ start)
        basis, _ = np.linalg.qr(projector @ basis, mode="complete")
        left = float(np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:]))
        if left < least:
            best, least = (basis[:, :k], basis[:, k:]), left
        if left <= tiny:
            break
    return best


def _divided(a: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors, in any order; ``tiny`` is what counts as zero."""
    off = a - np.diag(np.diag(a))
    parts = _split(a, 8 * tiny) if len(a) > 1 and np.linalg.norm(off) > tiny else None
    if parts is None:
        # One component, or components that no double tells apart.
        return np.diag(a).copy(), np.eye(len(a))
    values, vectors = [], []
    for part in parts:
        inner = part.T @ a @ part
        of_part, turned = _divided((inner + inner.T) / 2, tiny)
        values.append(of_part)
        vectors.append(part @ turned)
    return np.concatenate(values), np.concatenate(vectors, axis=1)


def _refined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of Newton's method on all eigenvectors together."""
    rest = np.eye(len(a)) - vectors.T @ vectors
    turned = vectors.T @ a @ vectors
    turned = (turned + turned.T) / 2
    values = np.diag(turned) / (1 - np.diag(rest))
    gap = values[None, :] - values[:, None]
    # The step neglects squares of turns, which are small unless values are close.
    apart = np.abs(gap) > 1e-6 * np.abs(values).max()
    change = np.where(apart, (turned + values * rest) / np.where(apart, gap, 1.0), rest / 2)
    return values, vectors + vectors @ change


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns."""
    size = float(np.linalg.norm(a))
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    scaled = a / size
    _, vectors = _divided(scaled, 4 * np.finfo(float).eps)
    for _ in range(2):
        values, vectors = _refined(scaled, vectors)
    vectors /= np.linalg.norm(vectors, axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, vectors[:, order]


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """The vectors' whole numbers, one row each."""
    numbers = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * numbers).astype(np.int64).reshape(-1, width) + MOVED


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n`` times each row less ``sums``, in integers of Python where 64 bits are too few."""
    largest = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, sums))
    if largest < 2**63:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(moved: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    if moved.dtype == object:
        return (moved * moved).sum(axis=1).tolist()
    largest = int(np.abs(moved).max(initial=0))
    if largest * largest * moved.shape[1] < 2**63:
        return (moved * moved).sum(axis=1).tolist()
    # Limbs whose products add up within 64 bits.
    size = np.abs(moved)
    limbs = [(size >> (_LIMB * i)) & ((1 << _LIMB) - 1) for i in range(4)]
    total = [0] * len(moved)
    for i in range(4):
        for j in range(i, 4):
            part = (limbs[i] * limbs[j]).sum(axis=1) * (1 if i == j else 2)
            if part.any():
                total = [t + (p << (_LIMB * (i + j))) for t, p in zip(total, part.tolist(), strict=True)]
    return total


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & whole)


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        high, low = np.zeros(width, object), np.zeros(width, object)
        for batch in batches:
            x = whole_numbers(batch.column(0), width)
            n += len(x)
            # In two halves, so that no batch overflows.
            high += (x >> 32).sum(axis=0)
            low += (x & _LOW).sum(axis=0)
        total = [Decimal(int(h) * (_LOW + 1) + int(k)) for h, k in zip(high, low, strict=True)]
        columns = [
            pa.array(range(width), pa.int32()),
            pa.array([n] * width, pa.int64()),
            pa.array(total, pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "total"])

    parts = rows.mapInArrow(run, "i int, n bigint, total decimal(38, 0)")
    found = parts.groupBy("i").agg(F.sum("n"), F.sum("total")).orderBy("i").collect()
    return (found[0][1], [int(row[2]) for row in found]) if found else (0, [])


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the whole numbers; the mean is taken off before they are multiplied."""
    width = len(sums)
    one, two = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.zeros((width, width))
        for batch in batches:
            x = whole_numbers(batch.column(0), width)
            for i in range(0, len(x), BLOCK):
                y = centred(x[i : i + BLOCK], n, sums).astype(np.float64) / n
                scatter += y.T @ y
        columns = [pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(scatter[one, two])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])

    parts = rows.mapInArrow(run, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (found.column(k).to_numpy() for k in ("i", "j", "v"))
    covariance = np.zeros((width, width))
    covariance[i, j] = covariance[j, i] = v / n
    return covariance


def _identity_error(rows: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity."""
    at = [F.col("whitened")[i] for i in range(k)]
    means = rows.agg(*[F.sum(x) / n for x in at]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moved = [x - F.lit(float(mean)) for x, mean in zip(at, means, strict=True)]
    entries = rows.agg(*[F.sum(moved[i] * moved[j]) / n for i, j in pairs]).first()
    return max(abs(float(v) - (i == j)) for v, (i, j) in zip(entries, pairs, strict=True))


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """Per vector and leading component its ``whitened`` coordinate: ``key``, ``component`` (from
    1, by falling variance), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries become whole numbers x, ``SCALE`` times as large, rounded down and moved by
    ``MOVED``. ``n`` counts the vectors; ``deviation`` (decimal, exact) is the sum over the
    dimensions of the squares of n * x less the dimension's sum; ``explained`` is the
    component's share of all variance.

    Vectors that are null, empty, or hold a null or a number that is not finite, or of
    ``MOST`` and more, have no rows, nor have those of another width than most vectors
    (ties: the wider). Repeated rows count each and give rows each; other columns play no
    part. Components without variance are left out, so equal vectors, a single one, and an
    empty table have no rows. Of components of equal variance any basis may come.

    The driver gets one number per pair of dimensions, whatever the number of vectors.
    """
    usable = _usable(vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")), "_vector")
    widths = usable.groupBy(F.size("_vector").alias("width")).count()
    common = widths.orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    width = common[0]["width"] if common else 1
    usable = usable.filter(F.size("_vector") == width)
    n, sums = _sums(usable.select("_vector"), width)
    key_type = vectors.schema[key].dataType.simpleString()
    if n:
        covariance = _covariance(usable.select("_vector"), n, sums)
        variances, basis = components(covariance)
        trace = float(np.trace(covariance))
        k = int((variances[:most] > LEAST_SHARE * max(variances[0], 0.0)).sum())
    else:
        k = 0
    if not k:
        empty = f"`{key}` {key_type}, component int, n bigint, deviation decimal(38, 0), " \
            "whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    turn = basis[:, :k] / np.sqrt(variances[:k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            moved = centred(whole_numbers(batch.column(1), width), n, sums)
            exact = [Decimal(int(v)) for v in deviations(moved)]
            columns = [
                batch.column(0),
                pa.array(exact, pa.decimal128(38, 0)),
                pa.array(list(moved.astype(np.float64) / n @ turn), pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "deviation", "whitened"])

    schema = f"_key {key_type}, deviation decimal(38, 0), whitened array<double>"
    rows = materialize(usable.mapInArrow(run, schema), "whitened")
    error = _identity_error(rows, n, k)
    shares = F.lit([float(v / trace) for v in variances[:k]])
    each = rows.select("_key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        F.col("_key").alias(key),
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
