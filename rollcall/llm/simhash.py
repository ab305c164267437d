"""Near-duplicates by SimHash: fingerprints compared exactly, tile by tile.

Equal fingerprints are one node before anything is compared. Nodes are dealt into tiles by the
population counts of the parts of their fingerprints. Each differing bit changes one of these counts
by one, so tiles whose counts differ by more than the radius in sum are skipped; the others are
compared in full, by exclusive-or and bit counts, in pieces of about ``TILE`` fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clusters import spanning_links
from .common import join_counted, small_batches, written
from .components import connected_components

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints in a piece of a tile, more or less.
TILE = 2048
#: Parts of a fingerprint that are counted, and up to how many fingerprints: the more there are,
#: the finer the tiles. This decides only how much is compared in vain.
PARTS = ((2_000_000, 4), (200_000_000, 8), (None, 16))
#: Shingles hashed at a time, of however long a text.
CHUNK = 100_000


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The SimHash of the ``k``-word shingles, repeats included; 0 without words.

    A-Z count as a-z. A bit is set if it is set in over half of the shingles' XXH64.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(k, len(words))
    n = len(words) - k + 1
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        to = min(at + CHUNK, n)
        spans = zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, print) for every row of ``docs(doc_id, text)``; print is a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = np.array([fingerprint(t, k) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, print long"
    )


def _counts(parts: int) -> Column:
    """The population counts of the parts of ``print``, side by side in one number."""
    bits = 64 // parts
    mask = F.lit((1 << bits) - 1 if parts > 1 else -1).cast("long")
    total = F.lit(0).cast("long")
    for i in range(parts):
        part = F.shiftrightunsigned("print", bits * i).bitwiseAND(mask)
        total = total + F.shiftleft(F.bit_count(part).cast("long"), bits * i)
    return total


def _steps(parts: int, radius: int) -> list[int]:
    """From a tile's number to those of its neighbours within ``radius``, one way only."""
    bits, near = 64 // parts, {0}
    for _ in range(radius):
        near |= {at + s * (1 << bits * i) for at, i, s in product(near, range(parts), (1, -1))}
    return sorted(x for x in near if x > 0)


def _tile_pairs(tiles: DataFrame, steps: list[int]) -> DataFrame:
    """Pieces to compare, (a, a_piece, b, b_piece), of ``tiles(tile, pieces)``; each pair once."""
    every = F.explode(F.array(*[F.lit(s).cast("long") for s in steps]))
    a = tiles.select(F.col("tile").alias("a"), F.col("pieces").alias("a_pieces"), every.alias("step"))
    b = tiles.select(F.col("tile").alias("b"), F.col("pieces").alias("b_pieces"))
    apart = a.join(b, F.col("a") + F.col("step") == F.col("b")).drop("step")
    alone = tiles.select(
        F.col("tile").alias("a"), F.col("pieces").alias("a_pieces"),
        F.col("tile").alias("b"), F.col("pieces").alias("b_pieces"),
    )
    both = apart.unionByName(alone)
    both = both.withColumn("a_piece", F.explode(F.sequence(F.lit(0), F.col("a_pieces") - 1)))
    both = both.withColumn("b_piece", F.explode(F.sequence(F.lit(0), F.col("b_pieces") - 1)))
    return both.filter("a <> b or a_piece <= b_piece").select("a", "a_piece", "b", "b_piece")


def near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two arrays of fingerprints that differ in ``radius`` bits at most."""
    return np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)


def _compared(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {}
            for side in ("a", "b"):
                column = batch.column(side)
                flat = column.flatten()
                lists[side] = (
                    flat.field("print").to_numpy().view(np.uint64), flat.field("node").to_numpy(),
                    np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]),
                )
            (ap, an, at), (bp, bn, bt) = lists["a"], lists["b"]
            out = []
            for i in range(len(batch)):
                a, b = slice(at[i], at[i + 1]), slice(bt[i], bt[i + 1])
                left, right = near(ap[a], bp[b], radius)
                links = np.stack([an[a][left], bn[b][right]])
                links = links[:, links[0] != links[1]]
                if links.shape[1] > at[i + 1] - at[i] + bt[i + 1] - bt[i]:
                    nodes = np.unique(links)
                    pairs = zip(*np.searchsorted(nodes, links).tolist())
                    links = np.array(spanning_links(nodes.tolist(), pairs), np.int64).T
                out.append(links)
            links = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
            if links.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["u", "v"])

    return run


def near_fingerprints(nodes: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """(u, v): links that connect what is within ``radius`` bits, of ``nodes(print, node)``.

    Each print comes once. Every pair of fingerprints that may be near is compared; where a pair
    of pieces has more links than fingerprints, those that connect the same are handed on.
    """
    n = nodes.count()
    if parts is None:
        parts = next(p for limit, p in PARTS if limit is None or n <= limit)
    placed = nodes.select("print", "node", _counts(parts).alias("tile"))
    pieces = F.ceil(F.col("n") / TILE).cast("int").alias("pieces")
    tiles = written(placed.groupBy("tile").agg(F.count("*").alias("n")).select("tile", "n", pieces), "sim-tiles")
    piece = F.pmod(F.xxhash64("print"), F.col("pieces").cast("long")).cast("int").alias("piece")
    pieces = (
        join_counted(placed, tiles, "tile", "n", n)
        .select("tile", piece, F.struct("print", "node").alias("own"))
        .groupBy("tile", "piece").agg(F.collect_list("own").alias("own"))
    )
    pieces = written(pieces, "sim-pieces")
    a = pieces.select(F.col("tile").alias("a"), F.col("piece").alias("a_piece"), F.col("own").alias("a_own"))
    b = pieces.select(F.col("tile").alias("b"), F.col("piece").alias("b_piece"), F.col("own").alias("b_own"))
    pairs = _tile_pairs(tiles, _steps(parts, radius)).join(a, ["a", "a_piece"]).join(b, ["b", "b_piece"])
    return pairs.select(F.col("a_own").alias("a"), F.col("b_own").alias("b")).mapInArrow(
        _compared(radius), "u long, v long"
    )


def simhash_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``.

    Fingerprints of at most ``radius`` differing bits are linked; ``component_id`` is the smallest
    doc_id that links reach, the row's own included. ``fingerprint`` has 16 hex digits. Texts without
    words (null, empty, blank) have fingerprint 0, which is linked like any other; very long
    texts are hashed whole. doc_id, an integer, names a document: rows that share one are one
    document, whose fingerprints are joined. Rows without a doc_id are linked with nothing
    and have no component_id. An empty table gives an empty one; other columns are ignored.
    """
    prints = written(fingerprints(docs, k), "sim-prints")
    known = prints.filter("doc_id is not null")
    nodes = known.groupBy("print").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    nodes = written(nodes, "sim-nodes")
    links = near_fingerprints(nodes.select("print", "node"), radius)
    many = known.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b")).filter("a <> b")
    shared = known.select("doc_id", "print").distinct().join(many.select("doc_id"), "doc_id")
    own = shared.join(nodes, "print").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    joined = connected_components(links.unionByName(own))
    component = F.coalesce("root", "node").alias("component")
    known = nodes.join(joined, "node", "left").select("print", component, "copies")
    total = prints.count()
    rows = join_counted(prints, written(known, "sim-known"), "print", "copies", total)
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )
