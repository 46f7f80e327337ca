"""Components of chains, stars and random graphs against union-find."""

from __future__ import annotations

import random

import pytest

from quaywork.llm.components import components


def brute(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    return {frozenset(y for y in parent if find(y) == find(x)) for x in parent}


GRAPHS = {
    "chain": [(i, i + 1) for i in range(200)],
    "star": [(0, i) for i in range(1, 300)],
    "random": [(random.Random(i).randrange(300), random.Random(-i).randrange(300)) for i in range(170)],
    "odd": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None), (-7, 9)],
    "none": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    links = spark.createDataFrame(GRAPHS[name], "a bigint, b bigint")
    groups: dict = {}
    for r in components(links).collect():
        groups.setdefault(r["component"], set()).add(r["node"])
    assert {frozenset(g) for g in groups.values()} == brute(GRAPHS[name])
