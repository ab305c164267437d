"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of a sample of labelled text. A new
text is parsed from left to right into phrases, each the longest match that the automaton
has; a text takes few long phrases in its own language and many short ones in others. Phrases
times the bits that name a place in the sample, per character, estimate the cross entropy, and
the language with the least wins.

An automaton becomes a table of transitions in which a phrase that ends leads on to the first
step of the next one. Texts go through it in blocks of ``BLOCK`` characters, thousands
of blocks side by side; a phrase ends with its block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import code_points, small_batches

BLOCK = 512
#: The sample of a language: whole documents, by hash, and what of them is learned.
SAMPLE_DOCUMENTS = 64
SAMPLE_CHARS = 24_000
UNKNOWN = "und"


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower case, everything but letters and marks made one space."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), pattern=r"[^\p{L}\p{M}]+", replacement=" ")
    return pc.utf8_trim_whitespace(plain)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


class Parser:
    """The samples of all languages, made into tables where they are first used."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.samples = {k: samples[k] for k in sorted(samples)}
        self.tables: dict[str, np.ndarray] = {}
        self.symbol = np.empty(0, np.uint8)
        self.width = 0

    def build(self) -> None:
        letters = sorted(set("".join(self.samples.values())))
        self.width = len(letters) + 1
        kind = np.uint8 if self.width <= 256 else np.uint16
        self.symbol = np.zeros(0x110000, kind)
        self.symbol[[ord(c) for c in letters]] = np.arange(1, self.width)
        for lang, sample in self.samples.items():
            self.tables[lang] = self._table(self.symbol[[ord(c) for c in sample]].tolist())

    def _table(self, symbols: list[int]) -> np.ndarray:
        """``2 * width * next + 1`` where a phrase begins, without the 1 where one goes on.

        The last state is that of no open phrase: every step from it begins one.
        """
        step = suffix_automaton(symbols)
        closed, w = len(step), self.width
        begin = np.full(w, closed, np.int64)
        for c, q in step[0].items():
            begin[c] = q
        table = np.tile(2 * w * begin + 1, (closed + 1, 1))
        for p, row in enumerate(step):
            if row and p:
                table[p, list(row)] = 2 * w * np.array(list(row.values()))
        return table.reshape(-1)

    def phrases(self, lang: str, columns: list[np.ndarray], n: int) -> np.ndarray:
        """Phrases of ``n`` blocks; column t holds the t-th symbols of all blocks that long."""
        table, w = self.tables[lang], self.width
        count = np.zeros(n, np.int64)
        at = np.full(n, len(table) - w, np.int64)
        for column in columns:
            m = len(column)
            value = table[at[:m] + column]
            count[:m] += value & 1
            at[:m] = value >> 1
        return count


def side_by_side(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the texts' blocks, longest blocks first, and the text of each block."""
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = offsets[text] + number * BLOCK
    length = np.minimum(BLOCK, offsets[text + 1] - start)
    order = np.argsort(-length, kind="stable")
    text, start, length = text[order], start[order], length[order]
    columns = []
    for t in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -t, side="left"))
        columns.append(data[start[:m] + t])
    return columns, text


def identify(texts: pa.Array, parser: Parser) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    if not parser.tables:
        parser.build()
    points, offsets = code_points(letters_only(texts).to_pylist())
    columns, text = side_by_side(parser.symbol[points].astype(np.int64), offsets)
    n = np.diff(offsets)
    langs = list(parser.tables)
    bits = np.zeros((len(n), len(langs)))
    for j, lang in enumerate(langs):
        phrases = parser.phrases(lang, columns, len(text))
        total = np.bincount(text, phrases, minlength=len(n))
        bits[:, j] = total * np.log2(len(parser.samples[lang]) + 1) / np.maximum(n, 1)
    if not langs:
        return [UNKNOWN] * len(n), np.zeros(len(n))
    best = bits.argmin(1)
    least = bits[np.arange(len(n)), best]
    bits[np.arange(len(n)), best] = np.inf
    second = bits.min(1)
    score = np.where(np.isinf(second), 1.0, 1 - least / np.maximum(second, 1e-9))
    pred = [langs[j] if size else UNKNOWN for j, size in zip(best, n)]
    return pred, np.where(n > 0, np.clip(score, 0, 1), 0.0)


def learned() -> Column:
    """Whether a row may be learned from: its id's CRC-32 leaves another rest than 2 by 4."""
    return F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def language_samples(
    docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS
) -> dict[str, str]:
    """Per language up to ``chars`` characters of up to ``documents`` documents, chosen by hash.

    Only rows of ``docs(doc_id, text, lang)`` with a language and a text, which ``learned`` allows.
    Each chosen document gives an equal share. The languages are those of the labels.
    """
    rows = docs.filter(learned() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id"), F.lit(10)), "doc_id")
    chosen = (
        rows.select("doc_id", "lang").withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= documents).select("doc_id", "lang").distinct()
    )
    texts: dict[str, list[str]] = {}
    picked = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    for row in sorted(picked.collect()):
        texts.setdefault(row.lang, []).append(row.text)
    samples = {}
    for lang, own in texts.items():
        plain = [t for t in letters_only(pa.array(own)).to_pylist() if t]
        plain.sort(key=len)
        parts, left = [], chars
        for i, t in enumerate(plain):
            parts.append(t[: left // (len(plain) - i)])
            left -= len(parts[-1])
        if parts:
            samples[lang] = " ".join(parts)
    return samples


RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def language_of(text: Column, model: Broadcast) -> Column:
    """A struct of ``lang_pred`` and ``score`` (0 to 1, the lead over the next language).

    ``model`` broadcasts ``{"samples": language_samples(...)}``; a worker makes its parser of
    them once and keeps it there. ``und`` and 0 where a text is null or has no letter. Of equal
    languages the first by name.
    """

    @F.arrow_udf(RESULT)
    def parse(column: pa.Array) -> pa.Array:
        if "parser" not in model.value:
            model.value["parser"] = Parser(model.value["samples"])
        preds, scores = [], []
        for batch in small_batches(iter([pa.RecordBatch.from_arrays([column], ["text"])])):
            pred, score = identify(pc.fill_null(batch.column("text"), ""), model.value["parser"])
            preds += pred
            scores.append(score)
        score = np.concatenate(scores) if scores else np.empty(0)
        return pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return parse(text)
