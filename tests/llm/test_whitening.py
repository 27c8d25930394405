from __future__ import annotations

import math

import numpy as np
import pytest

from marlgrid.llm import whitening
from marlgrid.llm.queries import op12_whitening, read

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>"


def numbers(rows: list[tuple]) -> list[tuple[int, list[int]]]:
    return [
        (key, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector])
        for key, vector in rows
        if vector and all(c is not None and math.isfinite(c) for c in vector)
    ]


def check(found: list, rows: list[tuple], most: int = 8) -> None:
    """Compares with exact sums and numpy's eigenvectors."""
    x = numbers(rows)
    n = len(x)
    sums = [sum(column) for column in zip(*(v for _, v in x))]
    moved = np.array([[c - s / n for c, s in zip(v, sums)] for _, v in x])
    values, vectors = np.linalg.eigh(moved.T @ moved / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-10 * values[0]).sum()))
    assert len(found) == n * k
    want: dict = {}
    for (key, v), row in zip(x, moved @ vectors[:, :k] / np.sqrt(values[:k])):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        want.setdefault(key, []).append((deviation, row))
    sign: dict = {}
    for r in found:
        (deviation, row), *_ = want[r.vec_id]
        assert r.n == n and int(r.deviation) == deviation
        i = r.component - 1
        if abs(row[i]) > 0.1:
            sign.setdefault(i, np.sign(row[i] * r.whitened))
        assert abs(r.explained / (values[i] / values.sum()) - 1) < 1e-9
        assert r.identity_error < 1e-9
    for r in found:
        i = r.component - 1
        assert abs(r.whitened * sign[i] - want[r.vec_id][0][1][i]) < 1e-7


def made(n: int, width: int, seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    spread = np.linspace(1, 3, width)
    x = rng.normal(size=(n, width)) * spread @ np.linalg.qr(rng.normal(size=(width, width)))[0]
    return [(i, [float(v) for v in row.astype(np.float32)]) for i, row in enumerate(x)]


def test_components_of_hard_matrices():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    spectra = [
        np.linspace(1, 2, 40),
        np.geomspace(1e-12, 1, 40),
        np.repeat([5.0, 1.0], 20),
        np.concatenate([[1.0], np.zeros(39)]),
        np.ones(40),
        1 + 1e-9 * np.arange(40),
        np.concatenate([np.arange(1.0, 20), [20.0] * 2, np.arange(21.0, 40)]),
    ]
    for spectrum in spectra:
        a = (turn * spectrum) @ turn.T
        a = (a + a.T) / 2
        values, vectors = whitening.components(a)
        assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-14 * 40
        assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-13
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * max(1, spectrum.max())
    values, vectors = whitening.components(np.diag([1.0, 3.0, 2.0]))
    assert values.tolist() == [3, 2, 1] and np.abs(vectors).sum() == 3


def test_polar_factor():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    want = (vectors * np.sign(values)) @ vectors.T
    assert np.abs(whitening.polar(a) - want).max() < 1e-11


def test_deviations_are_exact_at_any_size():
    rng = np.random.default_rng(7)
    for size in (10, 2**31, 2**40, 2**62):
        moved = rng.integers(-size, size, (20, 7))
        want = [sum(int(v) ** 2 for v in row) for row in moved]
        assert whitening.deviations(moved) == want
        assert whitening.deviations(moved.astype(object)) == want
    x = np.array([[2**52 + 3, -5]])
    exact = [[(2**52 + 3) * 10**6 - 7, -5 * 10**6 - 8]]
    assert whitening.centred(x, 10**6, [7, 8]).tolist() == exact


@pytest.mark.parametrize("width", [1, 3, 12])
def test_against_brute_force(spark, width):
    rows = made(300, width)
    odd: list = [None, [None] * width, [float("nan")] * width, [float("inf")] * width, [], [1e30] * width]
    odd.append([1.0] * (width + 1))
    table = spark.createDataFrame(
        [(*r, 1, "x") for r in [*rows, *enumerate(odd, 1_000)]],
        f"{SCHEMA}, component int, whitened string",
    )
    check(whitening.whiten(table.repartition(7)).collect(), rows)


def test_repeats_and_tables_without_variance(spark):
    rows = made(50, 3)
    rows += [rows[4]] * 30 + [(None, rows[5][1])]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert found.count() == 0 and found.columns[:2] == ["vec_id", "component"]
    flat = [(i, [float(i), float(i), 1.0]) for i in range(20)]
    check(whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect(), flat)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF, "embeddings").collect()]
    found = op12_whitening(spark, SF)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), rows)
