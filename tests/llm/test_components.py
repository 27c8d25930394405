from __future__ import annotations

import random

import pytest
from graphs import components

from marlgrid.llm.components import connected_components


def chain(n):
    return [(i, i + 1) for i in range(n)]


def star(n):
    return [(n, i) for i in range(n)]


def scattered(n):
    rng = random.Random(n)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(n * 2 // 3)]


@pytest.mark.parametrize("links", [[], chain(60), star(200), scattered(150), chain(5) * 3])
def test_against_brute_force(spark, links):
    order = list(range(1_000))
    random.Random(1).shuffle(order)
    links = [(order[a], order[b]) for a, b in links]
    rows = [*links, (None, 1), (2, None), *[(b, a) for a, b in links[:3]]]
    edges = spark.createDataFrame(rows, "x bigint, y bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    assert got == components(nodes, [(a, b) for a, b in links if a != b])
