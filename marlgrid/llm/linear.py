"""Linear models that are fitted on the driver, on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled documents that a model is fitted on, in the mean.
SAMPLE = 8_000
HASH_RANGE = 1 << 30

STEPS = 300


def sigmoid(x: np.ndarray) -> np.ndarray:
    """The logistic function, without overflow."""
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    """The inverse of ``sigmoid``."""
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression, by accelerated gradient steps.

    ``ridge`` is the weight of the squared weights, the intercept's left out.
    """
    n, width = x.shape
    z = np.column_stack([x, np.ones(n)]).astype(np.float32)
    y = y.astype(np.float32)
    penalty = np.full(width + 1, ridge, np.float32)
    penalty[-1] = 0.0
    vector = np.ones(width + 1, np.float32)
    for _ in range(30):
        vector = z.T @ (z @ vector)
        vector /= np.linalg.norm(vector)
    steep = np.float32(0.25 * np.linalg.norm(z @ vector) ** 2 / n * 1.05 + ridge)
    weights = np.zeros(width + 1, np.float32)
    weights[-1] = logit(np.array((y.sum() + 1) / (n + 2)))
    ahead, pace = weights.copy(), 1.0
    for _ in range(STEPS):
        gradient = z.T @ (sigmoid(z @ ahead) - y) / n + penalty * ahead
        moved = ahead - gradient / steep
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = moved + (pace - 1) / faster * (moved - weights)
        if gradient @ (moved - weights) > 0:
            ahead, faster = moved.copy(), 1.0
        weights, pace = moved, faster
    return weights[:-1].astype(np.float64), float(weights[-1])


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    columns: dict[str, Column],
    size: int = SAMPLE,
    text: str = "text",
) -> DataFrame:
    """``key`` and ``text`` of ``docs`` with labels, about ``size`` of each label, drawn by a hash of ``key``.

    ``columns`` gives each label as a boolean over ``labels``. A document with
    several rows of labels has a label if any of them says so; a null says nothing. A
    document that lacks one label, or is drawn for another only, has a null there. Of
    several texts of one key, the one of the smallest digest stands for it.
    What is broadcast has at most about ``size`` rows of a few bytes per label.
    """
    number = F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.lit(HASH_RANGE))
    told = labels.filter(F.col(key).isNotNull())
    counts = told.agg(*[F.count(column) for column in columns.values()]).first()
    own = {
        name: F.when(number < (HASH_RANGE if n <= size else int(HASH_RANGE * size / n)), column)
        for (name, column), n in zip(columns.items(), counts, strict=True)
    }
    drawn = (
        told.filter(F.coalesce(*own.values()).isNotNull())
        .groupBy(F.col(key).alias("_drawn"))
        .agg(*[F.max(column.cast("int")).alias(name) for name, column in own.items()])
    )
    found = docs.join(F.broadcast(drawn), docs[key] == drawn["_drawn"])
    return found.groupBy(key, *columns).agg(F.min_by(text, F.md5(text)).alias(text))
