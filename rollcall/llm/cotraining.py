"""Quality by co-training: two classifiers with a view each, which teach one another.

One sees the text's characters (hashed trigrams), the other the page's metadata: source,
language, length, and how the lines are laid out. Both begin with the labelled rows; round by
round each gives the other the unlabelled rows it is surest of, as pseudo-labels. Labelled rows
set aside calibrate both, and a document's score joins the two calibrated views.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import powers, small_batches, span_hashes, spans, text_bytes, written
from .logistic import fit_logistic, sigmoid

#: Labelled and unlabelled rows that are learned from, chosen by hash.
LABELLED_ROWS = 6_000
POOL_ROWS = 6_000
ROUNDS = 4
#: A round hands on at most so many rows of each kind, and only at this confidence.
HANDED_ON = 300
CONFIDENCE = 0.95
TRIGRAMS = 256
SOURCES = 16
LANGS = 8
LAYOUT = 7


def content_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of hashed byte trigram counts, each row of length 1 (0 for an empty text)."""
    n = len(offsets) - 1
    out = np.zeros((n, TRIGRAMS))
    if len(data) >= 3:
        steps = powers(np.uint64(0x9E3779B97F4A7C15), 4)[1:].astype(np.uint32)
        b = data.astype(np.uint32)
        h = (b[:-2] * steps[0] + b[1:-1] * steps[1] + b[2:] * steps[2]) >> np.uint32(24)
        text = np.repeat(np.arange(n), np.diff(offsets))
        inside = text[2:] == text[:-2]
        cells = text[:-2][inside] * TRIGRAMS + h[inside]
        out = np.sqrt(np.bincount(cells, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS))
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1)


def metadata_view(
    data: np.ndarray, offsets: np.ndarray, source: list, lang: list, n_chars: list
) -> np.ndarray:
    """Hashed source and language, length, and layout of the lines; null is a value of its own."""
    n = len(offsets) - 1
    out = np.zeros((n, SOURCES + LANGS + LAYOUT))
    for i in range(n):
        out[i, zlib.crc32(str(source[i]).encode()) % SOURCES] = 1
        out[i, SOURCES + zlib.crc32(str(lang[i]).encode()) % LANGS] = 1
    starts, ends, at = spans(data != 10, offsets)
    n_lines = np.diff(at)
    text = np.repeat(np.arange(n), n_lines)
    size = ends - starts
    most = np.zeros(n)
    np.maximum.at(most, text, size)
    short = np.bincount(text[size < 20], minlength=n) / np.maximum(n_lines, 1)
    h = span_hashes(data, starts, ends)
    order = np.lexsort((h, text))
    same = (np.diff(h[order]) == 0) & (np.diff(text[order]) == 0)
    again = np.bincount(text[order][1:][same], minlength=n) / np.maximum(n_lines, 1)
    blanks = np.concatenate([[0], np.cumsum(data == 32)])
    blank = (blanks[offsets[1:]] - blanks[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)
    told = np.array([x or 0 for x in n_chars], float)
    layout = [
        np.log1p(np.maximum(told, 0)) / 10, np.log1p(n_lines) / 5,
        np.log1p(np.diff(offsets) / np.maximum(n_lines, 1)) / 10, np.log1p(most) / 10,
        short, again, blank,
    ]
    out[:, SOURCES + LANGS :] = np.stack(layout, 1)
    return out


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column("text"))
    rest = [batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")]
    return content_view(data, offsets), metadata_view(data, offsets, *rest)


def sampled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(text, source, lang, n_chars, label): labelled rows, and others with label null, by hash.

    Rows whose id leaves 0 by CRC-32 and 5 are left out, so that a test may hold them back.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
        .filter("id is not null and label is not null")
        .filter(F.crc32(F.col("id").cast("string")) % 5 != 0)
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    order = [F.xxhash64("id", F.lit(2)), F.col("id")]
    ids = docs.select(F.col("doc_id").alias("id")).filter("id is not null").distinct()
    pool = ids.join(labels.select(F.col("doc_id").alias("id")), "id", "left_anti")
    pool = pool.orderBy(*order).limit(POOL_ROWS).withColumn("label", F.lit(None).cast("int"))
    chosen = known.orderBy(*order).limit(LABELLED_ROWS).unionByName(pool)
    return docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).select(
        "text", "source", "lang", "n_chars", "label"
    )


def sampled_views(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both views and labels (-1 for none) of a bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            content, meta = (v.astype(np.float32) for v in views(batch))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in content], pa.binary()),
                 pa.array([x.tobytes() for x in meta], pa.binary()), batch.column("label")],
                ["content", "meta", "label"],
            )

    found = rows.mapInArrow(run, "content binary, meta binary, label int").collect()
    found.sort(key=lambda r: (bytes(r.content), bytes(r.meta)))
    read = lambda c, w: np.array([np.frombuffer(r[c], np.float32) for r in found], float).reshape(-1, w)
    y = np.array([-1 if r.label is None else r.label for r in found], int)
    return read("content", TRIGRAMS), read("meta", SOURCES + LANGS + LAYOUT), y


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return fit_logistic(x, y.astype(float), np.zeros(x.shape[1]), strength=0.1)


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def co_train(content: np.ndarray, meta: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Weights of both views, their calibration, and the share of label 1."""
    labelled = np.flatnonzero(y >= 0)
    share = float(y[labelled].mean()) if len(labelled) else 0.5
    model = {"share": share, "weights": None}
    if len(set(y[labelled].tolist())) < 2:
        return model
    aside = labelled[::4]
    base = np.setdiff1d(labelled, aside)
    if len(set(y[base].tolist())) < 2 or len(set(y[aside].tolist())) < 2:
        base = aside = labelled
    pool = set(np.flatnonzero(y < 0).tolist())
    seen = [(content, list(base), list(y[base])), (meta, list(base), list(y[base]))]
    weights = [_fit(x[rows], np.array(own)) for x, rows, own in seen]
    for _ in range(rounds):
        given: list[dict[int, int]] = [{}, {}]
        free = np.array(sorted(pool), int)
        if not len(free):
            break
        for v in (0, 1):
            p = sigmoid(_logit(seen[v][0][free], weights[v]))
            order = np.argsort(p, kind="stable")
            sure = [i for i in order[::-1][: int(HANDED_ON * share) + 1] if p[i] >= CONFIDENCE]
            unsure = [i for i in order[: int(HANDED_ON * (1 - share)) + 1] if p[i] <= 1 - CONFIDENCE]
            given[1 - v].update({int(free[i]): 1 for i in sure} | {int(free[i]): 0 for i in unsure})
        for v in (0, 1):
            seen[v][1].extend(given[v])
            seen[v][2].extend(given[v].values())
            pool -= set(given[v])
            weights[v] = _fit(seen[v][0][seen[v][1]], np.array(seen[v][2]))
    scale = [
        fit_logistic(_logit(x[aside], w)[:, None], y[aside].astype(float), np.ones(1), 1.0)
        for (x, _, _), w in zip(seen, weights)
    ]
    return model | {"weights": weights, "scale": scale}


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    """The model from a bounded sample; without labels of both kinds every score is their share."""
    rows = written(sampled_rows(docs, labels, label), "quality-rows")
    return co_train(*sampled_views(rows))


RESULT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")])


def quality_scores(text: Column, source: Column, lang: Column, n_chars: Column, model: Broadcast) -> Column:
    """A struct of the calibrated scores of both views and of both together, 0 to 1."""

    @F.arrow_udf(RESULT)
    def score(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        m = model.value
        parts = []
        whole = pa.RecordBatch.from_arrays([text, source, lang, n_chars], ["text", "source", "lang", "n_chars"])
        for batch in small_batches(iter([whole])):
            if m["weights"] is None:
                parts.append(np.full((batch.num_rows, 3), m["share"]))
                continue
            logits = [
                _logit(x, w) * s[0] + s[1] for x, w, s in zip(views(batch), m["weights"], m["scale"])
            ]
            prior = np.log(m["share"] / (1 - m["share"]))
            parts.append(sigmoid(np.stack([*logits, sum(logits) - prior], 1)))
        out = np.concatenate(parts) if parts else np.empty((0, 3))
        return pa.StructArray.from_arrays([pa.array(out[:, j]) for j in range(3)], RESULT.fieldNames())

    return score(text, source, lang, n_chars)
