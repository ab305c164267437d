"""Quality rules: base counts of whole texts, and divergence from language references.

A document is compared with references made of all documents of a language: a histogram of
character classes and one of the language's most common words and all others together. The
measure is the Jensen-Shannon distance (base 2, from 0 to 1); a document is judged by the
nearest reference, whatever its own language label says. Guards keep short documents and
languages with too little text out of the comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import small_batches, solid, span_hashes, spans, text_bytes, windows, written

#: Character classes: a-z, A-Z, 0-9, whitespace, common punctuation, other ASCII, all else.
CLASSES = 7
PUNCTUATION = ".,;:!?'\"()-"

_CLASS = np.full(256, 5, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[list(PUNCTUATION.encode())] = 4
_CLASS[0x80:] = 6
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Production thresholds. Distances are the largest that still pass."""

    min_words: int = 20
    max_repeat_percent: int = 30
    char_distance: float = 0.24
    word_distance: float = 0.37
    min_chars_for_chars: int = 200
    min_words_for_words: int = 100
    common_words: int = 50
    min_reference_words: int = 2_000


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    first = ~_CONTINUES[data]
    cells = text[first] * CLASSES + _CLASS[data[first]]
    return np.bincount(cells, minlength=n * CLASSES).reshape(n, CLASSES)


def base_counts(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, at: np.ndarray) -> dict:
    """The base columns of every text; ``h`` and ``at`` are its words' hashes and offsets."""
    inside = solid(data)
    n_words = np.diff(at)

    line_start, line_end, line_at = spans(data != 10, offsets)
    filled = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    worded = filled[line_end] > filled[line_start]
    line_text = np.repeat(np.arange(len(offsets) - 1), np.diff(line_at))[worded]
    line_hash = span_hashes(data, line_start[worded], line_end[worded])
    order = np.lexsort((line_hash, line_text))
    again = (np.diff(line_hash[order]) == 0) & (np.diff(line_text[order]) == 0)
    n_dup = np.bincount(line_text[order][1:][again], minlength=len(offsets) - 1)

    values, start = windows(h, at, 8)
    word_text = np.repeat(np.arange(len(at) - 1), n_words)
    of = word_text[start]
    order = np.lexsort((values, of))
    same = (np.diff(values[order]) == 0) & (np.diff(of[order]) == 0)
    twice = np.zeros(len(values), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(h) + 1, np.int64)
    np.add.at(steps, start[twice], 1)
    np.add.at(steps, start[twice] + 8, -1)
    covered = np.cumsum(steps)[: len(h)] > 0
    return {
        "n_words": n_words.astype(np.int64),
        "word_chars": _per_text(inside & ~_CONTINUES[data], offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": n_dup.astype(np.int64),
        "n_repeat_words": _per_text(covered, at),
    }


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = spans(solid(data), offsets)
    return span_hashes(data, starts, ends), at


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, item, n): kind 0 counts character classes, kind 1 words by their hash.

    Counts of a task are merged while it runs and handed on when they are many.
    """
    parts: dict[tuple[str, int], list] = {}

    def merged() -> int:
        for k, (keys, counts) in parts.items():
            keys, counts = np.concatenate(keys), np.concatenate(counts)
            unique, back = np.unique(keys, return_inverse=True)
            total = np.bincount(back, counts, len(unique)).astype(np.int64)
            parts[k] = [[unique], [total]]
        return sum(len(v[0][0]) for v in parts.values())

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, kind), (keys, counts) in parts.items():
            n = len(keys[0])
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang]).take(pa.array(np.zeros(n, np.int64))),
                "kind": pa.array(np.full(n, kind, np.int32)),
                "item": pa.array(keys[0].view(np.int64)),
                "n": pa.array(counts[0]),
            })
        parts.clear()

    pending = 0
    for batch in small_batches(batches):
        data, offsets = text_bytes(batch.column("text"))
        h, at = _words(data, offsets)
        classes = _class_counts(data, offsets)
        langs = batch.column("lang").to_pylist()
        text = np.repeat(np.arange(len(langs)), np.diff(at))
        for lang in set(langs):
            own = np.array([x == lang for x in langs])
            keys, counts = np.unique(h[own[text]], return_counts=True)
            for kind, k, n in ((0, np.arange(CLASSES, dtype=np.uint64), classes[own].sum(0)), (1, keys, counts)):
                cell = parts.setdefault((lang, kind), [[], []])
                cell[0].append(k)
                cell[1].append(n)
            pending += len(keys)
        if pending > 1_000_000:
            pending = merged()
            if pending > 700_000:
                yield from handed_on()
                pending = 0
    merged()
    yield from handed_on()


def language_references(docs: DataFrame, limits: Limits = Limits()) -> dict[str, dict]:
    """Per language the shares of character classes and of its most common words.

    Counted over all documents with a language and a text. ``{}`` if no language has
    ``min_reference_words``; only those that have reach the driver, each with its classes and at
    most ``common_words`` words. Words of equal count are common together or not at all, so that
    no order among them matters: common are those more frequent than the word after the last place.
    """
    counts = (
        docs.select("lang", "text")
        .filter("lang is not null and text is not null")
        .mapInArrow(_tally, "lang string, kind int, item long, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    counts = written(counts, "quality-counts")
    words = counts.filter("kind = 1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    large = written(totals.filter(F.col("total") >= limits.min_reference_words), "quality-languages")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc()))
    top = words.withColumn("place", place).filter(F.col("place") <= limits.common_words + 1)
    after = F.max(F.when(F.col("place") > limits.common_words, F.col("n"))).over(Window.partitionBy("lang"))
    common = top.withColumn("after", after).filter(F.col("n") > F.coalesce("after", F.lit(0)))
    total = {r.lang: r.total for r in large.collect()}
    out: dict[str, dict] = {x: {"chars": np.zeros(CLASSES), "words": {}} for x in sorted(total)}
    for r in counts.filter("kind = 0").join(large, "lang", "left_semi").collect():
        out[r.lang]["chars"][r.item] = r.n
    for r in common.join(large, "lang", "left_semi").select("lang", "item", "n").collect():
        out[r.lang]["words"][r.item] = r.n / total[r.lang]
    for ref in out.values():
        ref["chars"] = ref["chars"] / ref["chars"].sum()
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of every row of ``p`` to the distribution ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _distances(h, at, classes, references) -> tuple[np.ndarray, np.ndarray]:
    n = len(at) - 1
    chars = classes / np.maximum(classes.sum(1, keepdims=True), 1)
    char_d, word_d = np.full(n, np.inf), np.full(n, np.inf)
    n_words = np.diff(at)
    text = np.repeat(np.arange(n), n_words)
    for ref in references.values():
        char_d = np.minimum(char_d, js_distance(chars, ref["chars"]))
        if not ref["words"]:
            continue
        keys = np.array(sorted(np.int64(k) for k in ref["words"]), np.int64)
        q = np.array([ref["words"][int(k)] for k in keys])
        q = np.append(q, max(0.0, 1 - q.sum()))
        place = np.searchsorted(keys, h.view(np.int64))
        place[place == len(keys)] = 0
        place = np.where(keys[place] == h.view(np.int64), place, len(keys))
        counts = np.bincount(text * len(q) + place, minlength=n * len(q)).reshape(n, len(q))
        word_d = np.minimum(word_d, js_distance(counts / np.maximum(n_words, 1)[:, None], q))
    return char_d, word_d


RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(c, T.DoubleType()) for c in ("char_distance", "word_distance")]
    + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
)


def quality_verdict(
    text: Column, references: dict[str, dict], limits: Limits = Limits()
) -> Column:
    """A struct per text: base counts, distances to the nearest reference, and the verdict.

    Null and empty texts have no words, and so fail the base rules. A distance is null where
    a guard stops the comparison: too short a text, or no reference. Such a text passes.
    """

    @F.arrow_udf(RESULT)
    def judge(column: pa.Array) -> pa.Array:
        out = []
        whole = pa.RecordBatch.from_arrays([column], ["text"])
        for batch in small_batches(iter([whole])):
            data, offsets = text_bytes(batch.column("text"))
            h, at = _words(data, offsets)
            counts = base_counts(data, offsets, h, at)
            classes = _class_counts(data, offsets)
            char_d, word_d = _distances(h, at, classes, references)
            no_chars = (classes.sum(1) < limits.min_chars_for_chars) | np.isinf(char_d)
            no_words = (counts["n_words"] < limits.min_words_for_words) | np.isinf(word_d)
            failed = (counts["n_words"] < limits.min_words) | (
                100 * counts["n_repeat_words"] > limits.max_repeat_percent * counts["n_words"]
            )
            near = (no_chars | (char_d <= limits.char_distance)) & (
                no_words | (word_d <= limits.word_distance)
            )
            arrays = [pa.array(v) for v in counts.values()]
            arrays += [pa.array(char_d, mask=no_chars), pa.array(word_d, mask=no_words)]
            arrays += [pa.array(failed), pa.array(~failed & near)]
            out.append(pa.StructArray.from_arrays(arrays, [f.name for f in RESULT.fields]))
        if not out:
            return pa.array([], pa.struct([(f.name, pa.int64()) for f in RESULT.fields]))
        return pa.concat_arrays(out)

    return judge(text)
