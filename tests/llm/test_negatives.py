import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import negatives as m

COLUMNS = "vec_id long, embedding array<float>, label int, vec string, score int, shard string, key int"


def plain_vectors(rows):
    good = [
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in e))
        for i, e, label in rows
        if i is not None and label is not None and e is not None
        and all(x is not None and math.isfinite(x) for x in e)
    ]
    return sorted(set(good))


def plain_negatives(rows, anchors):
    """All scores of all anchors with all rows."""
    out = []
    for a, label, q in rows:
        if not anchors(a):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, at == label) for i, at, v in rows]
        same = sorted((s, i) for s, i, x in scored if x and i != a)[: m.POSITIVES]
        other = sorted((s, i) for s, i, x in scored if not x)
        for p, pid in same:
            fit = [(s, i) for s, i in other if 30 * -p <= 100 * -s <= 90 * -p][: m.NEGATIVES]
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def found(df, every):
    return sorted(tuple(r) for r in m.hard_negatives(m.whole_vectors(df), F.col("vec_id") % every == 0).collect())


def data(seed, n=400, dim=7):
    """Clusters, copies of vectors, ties, and a hot vector."""
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.05) for x in rng.choice(middles)]
        if rows and i % 3 == 0:
            v = rows[i // 6][1]
        rows.append((i, [float(np.float32(x)) for x in v], rng.randint(0, 3)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], COLUMNS)


@pytest.mark.parametrize("seed, dim, shard_rows", [(0, 7, 4000), (1, 2, 60), (2, 1, 100), (3, 12, 35)])
def test_against_all_scores(spark, monkeypatch, seed, dim, shard_rows):
    monkeypatch.setattr(m, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(m, "FIRST_ROWS", 8)
    rows = data(seed, dim=dim)
    want = plain_negatives(plain_vectors(rows), lambda i: i % 11 == 0)
    assert found(frame(spark, rows), 11) == want and want


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (None, [0.5, 0.5], 1), (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.25, 0.5], 1), (2, None, 1),
        (3, [0.5, None], 1), (4, [0.5, inf], 1), (5, [nan, 0.5], 1), (6, [0.5, 0.5], None), (7, [0.5, 0.5], 1),
        (8, [0.25, 0.5], 2), (9, [0.25, 0.5], 2), (10, [0.5], 2), (11, [], 2), (12, [-0.5, -0.5], 1), (20, [0.75, 0.0], 3),
    ]
    df = frame(spark, rows)
    assert found(df, 10) == plain_negatives(plain_vectors(rows), lambda i: i % 10 == 0)
    assert m.hard_negatives(m.whole_vectors(df.limit(0)), F.lit(True)).count() == 0
    assert found(frame(spark, [(0, [], 1), (1, None, None)]), 1) == []


def test_cells_are_left_out():
    """With clustered vectors the bounds certify a search before all rows are scored."""
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 100, (16, 8))
    x = np.floor(middles[rng.integers(0, 16, 5000)] + rng.normal(0, 2, (5000, 8)))
    books = m.codebook(x[:1000, :4]), m.codebook(x[:1000, 4:])
    cells = m.Cells(np.arange(5000), np.zeros(5000, int), x, books)
    (top,), scored = cells.best(x[0], lambda i: np.ones(len(i), bool), [(-np.inf, np.inf)], 5)
    s = x @ x[0]
    want = np.lexsort((np.arange(5000), -s))[:5]
    assert top[1].tolist() == want.tolist() and scored < 2500
    bounds = list(cells.visit(x[0]))
    assert [b[0] for b in bounds] == sorted((b[0] for b in bounds), reverse=True)
    for upper, lower, cell in bounds:
        own = cells.x[cells.at[cell] : cells.at[cell + 1]] @ x[0]
        assert not len(own) or (own.max() <= upper and own.min() >= lower)
