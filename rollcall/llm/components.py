"""Connected components of an edge list too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, written

#: Edge lists counted to be no longer (3 MB) are solved in one task, without rounds.
SMALL_EDGES = 200_000


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``: root is the smallest node it can reach.

    Large-star and small-star steps by turns, until neither changes an edge. Every step is a
    partial aggregate and a join with one row per node; nodes with over a thousandth of all edges
    join by broadcast, so that none is drawn into one task. Edge lists of at most
    ``SMALL_EDGES`` are solved at once. Nulls and loops are ignored; repeated edges do no harm.
    """
    edges = written(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    if state[0] <= SMALL_EDGES:
        return edges.coalesce(1).mapInArrow(_solved, "node long, root long")
    for _ in range(max_rounds):
        edges = written(_large_star(edges, 2 * state[0]), "edges")
        edges = written(_small_star(edges, edges.count()), "edges")
        now = _state(edges)
        if now == state:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of an edge list that fits one task, in order, and the smallest node each can reach."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    ends = ends.reshape(2, -1)
    parent = np.arange(len(nodes))
    while True:
        a, b = parent[ends]
        apart = a != b
        if not apart.any():
            return nodes, nodes[parent]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(parent, up := parent[parent]):
            parent = up


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node with its root, from all edges at once."""
    both = [np.stack([b.column(c).to_numpy() for c in ("u", "v")]) for b in batches]
    if both:
        found = roots(*np.concatenate(both, 1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "root"])


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node, linked to the smallest of node and neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = least.select("u", F.least("u", "m").alias("m"), "n")
    return join_counted(both.filter("v > u"), least, "u", "n", total).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every smaller neighbour of a node and the node itself, linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = join_counted(edges, least, "u", "n", total).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.filter("u <> v").union(own).distinct()
