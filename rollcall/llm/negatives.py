"""Hard negatives by an inverted multi-index that certifies its windows.

Each half of a vector has a codebook of its own; the two nearest centres of a row name its cell. For an
anchor, a half's centre and radius (the largest distance of its rows) bound what its rows can score with
that half, and the sum of two bounds what a cell can. A heap over both sorted lists of half bounds visits
cells in descending order of these sums, and a search ends when no cell to come can hold a row
of its window. Codebooks are fitted on a bounded sample, every row is indexed, and results are exact.

Rows are dealt into shards by a hash of their id; a task holds the cells of one shard, and the anchors
stream past it. What shards find best is ranked over all shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Components are multiplied by this and rounded down.
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative scores between these percentages of the positive's score.
LOW, HIGH = 30, 90
#: Rows that codebooks are fitted on, and centres of each.
SAMPLE_ROWS = 10_000
CENTRES = 16
ROUNDS = 8
#: Bytes of vectors in a shard, and rows below which no further shard is worth it.
SHARD_BYTES = 64_000_000
SHARD_ROWS = 4_000
#: Rows scored at once to begin with; each next time twice as many.
FIRST_ROWS = 256


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, repeated rows once; vec holds integers.

    Rows with a null vec_id, label or vector, or any null or non-finite component, take no part.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    usable = embeddings.filter("vec_id is not null and label is not null and embedding is not null").filter(finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), whole.alias("vec")).distinct()


def codebook(points: np.ndarray, centres: int = CENTRES) -> np.ndarray:
    """Lloyd's centres of ``points``, the same ones every time; as many as there are points, if fewer."""
    unique = np.unique(points, axis=0)
    if len(unique) <= centres:
        return unique
    own = unique[np.random.default_rng(0).choice(len(unique), centres, replace=False)]
    for _ in range(ROUNDS):
        near = nearest(points, own)
        for c in range(centres):
            if (near == c).any():
                own[c] = points[near == c].mean(0)
    return own


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each point."""
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones go on with zeros."""
    sizes = pc.list_value_length(vectors).to_numpy()
    flat = vectors.flatten().to_numpy().astype(np.float64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(vectors), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Cells:
    """Rows sorted by cell, with the radii of both halves' centres."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> None:
        cut = books[0].shape[1]
        self.halves = []
        codes = []
        for book, part in zip(books, (x[:, :cut], x[:, cut:])):
            code = nearest(part, book)
            away = np.sqrt(((part - book[code]) ** 2).sum(1))
            radius = np.full(len(book), -1.0)
            np.maximum.at(radius, code, away)
            used = np.flatnonzero(radius >= 0)
            self.halves.append((book[used], radius[used], used))
            codes.append(code)
        self.cut, self.wide = cut, len(books[1])
        cell = codes[0] * self.wide + codes[1]
        order = np.lexsort((ids, cell))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.at = np.searchsorted(cell[order], np.arange(len(books[0]) * self.wide + 1))

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(upper bound, lower bound, cell) in descending order of the upper bound."""
        upper, lower, name = [], [], []
        for (centre, radius, used), part in zip(self.halves, (q[: self.cut], q[self.cut :])):
            size = np.sqrt((part**2).sum())
            middle = centre @ part
            # A little more than the exact bounds, for what rounding may take off.
            reach = size * radius * (1 + 1e-9) + 1e-6 + 1e-9 * np.abs(middle)
            order = np.argsort(-(middle + reach), kind="stable")
            upper.append((middle + reach)[order].tolist())
            lower.append((middle - reach)[order].tolist())
            name.append(used[order].tolist())
        (a, b), (la, lb), (na, nb) = upper, lower, name
        heap = [(-a[0] - b[0], 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, la[i] + lb[j], na[i] * self.wide + nb[j]
            if j + 1 < len(b):
                heapq.heappush(heap, (-a[i] - b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-a[i + 1] - b[0], i + 1, 0))

    def best(
        self, q: np.ndarray, takes, spans: list[tuple[float, float]], k: int
    ) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """Per span the ``k`` best rows (scores, ids) with a score in it; and how many were scored.

        ``takes`` says of rows, by index, which ones count.
        """
        tops = [(np.empty(0), np.empty(0, np.int64)) for _ in spans]
        floors = [low for low, _ in spans]
        ceiling = max(high for _, high in spans)
        held: list[tuple[int, int]] = []
        rows, batch, scored = 0, FIRST_ROWS, 0

        def score() -> None:
            index = np.concatenate([np.arange(a, b) for a, b in held])
            index = index[takes(index)]
            s = self.x[index] @ q
            for n, (low, high) in enumerate(spans):
                good = np.flatnonzero((s >= floors[n]) & (s <= high))
                all_s = np.concatenate([tops[n][0], s[good]])
                all_i = np.concatenate([tops[n][1], self.ids[index[good]]])
                first = np.lexsort((all_i, -all_s))[:k]
                tops[n] = all_s[first], all_i[first]
                if len(first) == k:
                    floors[n] = max(low, tops[n][0][-1])

        for bound, least, cell in self.visit(q):
            if rows >= batch:
                score()
                scored += rows
                held, rows, batch = [], 0, 2 * batch
            if bound < min(floors):
                break
            a, b = int(self.at[cell]), int(self.at[cell + 1])
            if a < b and least <= ceiling:
                held.append((a, b))
                rows += b - a
        if held:
            score()
            scored += rows
        return tops, scored


_FOUND = "anchor_id long, anchor_key long, of long, vec_id long, score long"


def _search(books: tuple[np.ndarray, np.ndarray], negatives: bool):
    """Best rows of a shard for every anchor: its positives, or negatives in the windows ``of`` its positives' scores."""
    dim = books[0].shape[1] + books[1].shape[1]

    def found(cells: Cells, batch: pa.RecordBatch) -> list[tuple]:
        out = []
        vectors = matrix(batch.column("vec"), dim)
        columns = (batch.column(c).to_pylist() for c in ("vec_id", "label", "key", "scores"))
        for q, vec_id, label, key, scores in zip(vectors, *columns):
            if negatives:
                spans = [(float(-(-LOW * s // 100)), float(HIGH * s // 100)) for s in scores]
                takes = lambda i: cells.labels[i] != label
            else:
                scores, spans = [0], [(-np.inf, np.inf)]
                takes = lambda i: (cells.labels[i] == label) & (cells.ids[i] != vec_id)
            tops, _ = cells.best(q, takes, spans, NEGATIVES if negatives else POSITIVES)
            for of, (s, ids) in zip(scores, tops):
                out += [(vec_id, key, of, i, int(x)) for x, i in zip(s.tolist(), ids.tolist())]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, cells = None, [], None
        for batch in batches:
            own = batch.column("shard").to_numpy() * 2 + batch.column("is_anchor").to_numpy(False)
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if own[a] // 2 != shard:
                    shard, held, cells = own[a] // 2, [], None
                if own[a] % 2 == 0:
                    held.append((
                        part.column("vec_id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("vec"), dim)
                    ))
                    continue
                if cells is None:
                    if not held:
                        continue
                    cells = Cells(*(np.concatenate(c) for c in zip(*held)), books)
                    held = []
                if rows := found(cells, part):
                    names = [c.split()[0] for c in _FOUND.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return run


def _over_shards(rows: DataFrame, anchors: DataFrame, shards: int, books, negatives: bool) -> DataFrame:
    """What every shard finds for ``anchors(vec_id, label, vec, key, scores)``, in the columns of ``_FOUND``."""
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    none = [F.lit(0).cast("long").alias("key"), F.lit(None).cast("array<long>").alias("scores")]
    indexed = rows.select(own, F.lit(False).alias("is_anchor"), "vec_id", "label", "vec", *none)
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = anchors.select(every, F.lit(True).alias("is_anchor"), "vec_id", "label", "vec", "key", "scores")
    return (
        indexed.unionByName(asked)
        .repartition(shards, "shard").sortWithinPartitions("shard", "is_anchor")
        .mapInArrow(_search(books, negatives), _FOUND)
    )


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """Hard negatives of ``vectors(vec_id, label, vec)``, as ``whole_vectors`` gives them.

    An anchor's positives are the ``POSITIVES`` best other rows of its label, its negatives for
    one of them the ``NEGATIVES`` best rows of other labels that score from ``LOW`` to ``HIGH`` percent
    of the positive. Scores are inner products; ties go by the smaller vec_id. An anchor or
    positive without negatives has no rows, so a positive with a score below 0 has none. Shorter
    vectors count as if they went on with zeros; scores are exact below 2^53. Rows that share a
    vec_id but differ are rows of their own, never each other's positives. An empty table
    gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = written(vectors, "neg-rows")
    n, dim = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n or not dim:
        return spark.createDataFrame([], _RESULT)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toArrow()
    points = matrix(sample.column("vec").combine_chunks(), dim)
    books = codebook(points[:, : dim // 2]), codebook(points[:, dim // 2 :])
    most = spark.sparkContext.defaultParallelism
    shards = max(-(-n * dim * 8 // SHARD_BYTES), min(most, -(-n // SHARD_ROWS)))
    anchors = rows.filter(is_anchor).withColumn("key", F.xxhash64("label", "vec"))
    asked = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    key = ["anchor_id", "anchor_key"]
    positives = written(_ranked(_over_shards(rows, asked, shards, books, False), key, POSITIVES), "neg-positives")
    scores = positives.filter("score >= 0").groupBy(*key).agg(F.collect_set("score").alias("scores"))
    same = (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))
    asked = anchors.join(scores, same).select("vec_id", "label", "vec", "key", "scores")
    found = _over_shards(rows, written(asked, "neg-asked"), shards, books, True)
    found = _ranked(found, [*key, "of"], NEGATIVES).select(
        *key, F.col("of").alias("positive_score"), "rank",
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    positives = positives.select(*key, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return positives.join(found, [*key, "positive_score"]).select(*[c.split()[0] for c in _RESULT.split(", ")])
