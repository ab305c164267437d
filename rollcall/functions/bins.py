"""Labelled bins."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_labels(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``low < value <= high``; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError(f"{len(labels)} labels need {len(labels) + 1} edges, not {len(edges)}")
    if any(low >= high for low, high in pairwise(edges)):
        raise ValueError(f"edges must increase: {list(edges)}")
    chain = F.when(value <= edges[0], F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        chain = chain.when(value <= high, F.lit(label))
    return chain
