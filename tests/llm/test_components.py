import random

import pytest

from rollcall.llm import components
from rollcall.llm.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    return {x: find(x) for x in root}


@pytest.mark.parametrize("at_once", [components.SMALL_EDGES, -1])
@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty"])
def test_components(spark, monkeypatch, kind, at_once):
    monkeypatch.setattr(components, "SMALL_EDGES", at_once)
    rng = random.Random(3)
    edges = {
        "random": [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(0, i) for i in range(1, 50)] + [(5, 5), (0, 7)],
        "empty": [],
    }[kind]
    df = spark.createDataFrame([*edges, (None, 1)], "u long, v long")
    rows = connected_components(df).collect()
    assert {r.node: r.root for r in rows} == brute(edges)
    assert len(rows) == len(brute(edges))
