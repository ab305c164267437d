"""Toxicity: terms of a learned lexicon, misspelled ones too, scored by their context.

The lexicon is learned: beginnings of words that are much commoner in toxic documents than in
others, counted over all labelled texts. Its trie is intersected with Levenshtein automata, one edit
for terms of five letters, two for ten, and the product is made deterministic as far as the words met
so far ask for, so that every word of a text is looked up in one pass over its first letters, all
words of a chunk side by side. What stands around a match
(quotation marks, verbs of saying, the second person) separates quotation from abuse, and a
logistic model weighs the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clusters import sent_if_small
from .common import code_points, small_batches, spans, written
from .logistic import fit_logistic, sigmoid

#: Labelled texts that the five weights are fitted on, chosen by hash; the lexicon counts all of them.
TRAIN_ROWS = 20_000
#: A term is in so many toxic texts that chance alone, at the share of toxic ones, would put them all
#: there with a probability of e to the minus this; in three of them at least ...
EVIDENCE = 10.0
#: ... and so many times commoner there than in others.
MIN_RATIO = 20.0
#: The words around a term are the same in at most this share of its toxic texts: what only near-copies
#: of one text hold, however many, is no term.
MAX_ALIKE = 0.5
#: States that a lookup keeps; beyond, it starts to fill anew.
STATES = 200_000
SHORTEST, LONGEST = 3, 12
AROUND = 6

# Signs of quotation, words of reporting, words that address someone.
QUOTES = "\"“”„«»‹›"
REPORTING = set(
    "said says say wrote writes called calls quote quoted quotes word term slur reported sagte sagt schrieb"
    " nannte zitat wort dit disait écrit appelé mot citation dijo dice escribió llamó palabra cita".split()
)
ADDRESS = set("you your yours youre u ur du dich dir dein euch ihr tu toi te ton vous votre tú ti usted vosotros".split())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Lookup:
    """A table that reads words from their first letter on and finds terms they begin with.

    A state is a set of (trie node, edits) and the fewest edits a term has been met with so far.
    States and steps are made when a word first needs them.
    """

    def __init__(self, terms: list[str]) -> None:
        letters = sorted(set("".join(terms)))
        self.symbol = np.zeros(0x110000, np.int64)
        self.symbol[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.alnum = np.frombuffer(bytes(chr(i).isalnum() for i in range(0x110000)), bool)
        self.depth = max((len(t) + allowed_edits(t) for t in terms), default=0)
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.reach: list[int] = [0]
        for term in terms:
            node, limit = 0, allowed_edits(term)
            self.reach[0] = max(self.reach[0], limit)
            for c in term:
                k = int(self.symbol[ord(c)])
                if k not in self.children[node]:
                    self.children[node][k] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.reach.append(0)
                node = self.children[node][k]
                self.reach[node] = max(self.reach[node], limit)
            self.ends[node] = limit
        self._clear()

    def _clear(self) -> None:
        """Only the start, in which nothing is read, is known."""
        self.number: dict[tuple[frozenset, int], int] = {}
        self.states: list[tuple[frozenset, int]] = []
        self.table = np.full((64, self.width), -1, np.int32)
        self.best = np.full(64, 9, np.int8)
        self._state((self._closed({0: 0}), 9))

    def _state(self, state: tuple[frozenset, int]) -> int:
        if state not in self.number:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            if n == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.best = np.concatenate([self.best, self.best])
            self.best[n] = state[1]
        return self.number[state]

    def _closed(self, pairs: dict[int, int]) -> frozenset:
        """With letters of the term left out; the fewest edits per node."""
        todo = list(pairs)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                e = pairs[node] + 1
                if e <= self.reach[child] and e < pairs.get(child, 9):
                    pairs[child] = e
                    todo.append(child)
        return frozenset(pairs.items())

    def _step(self, state: int, k: int) -> int:
        """The state after one more letter; once a term is met without edits nothing can be better."""
        pairs, had = self.states[state]
        out: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and e < out.get(node, 9):
                out[node] = e

        for node, e in pairs if had else ():
            put(node, e + 1)
            for c, child in self.children[node].items():
                put(child, e if c == k else e + 1)
        after = self._closed(out)
        met = min((e for node, e in after if e <= self.ends[node]), default=9)
        return self._state((after, min(had, met)))

    def edits(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per word the fewest edits of a term that it begins with, 9 if of none."""
        if len(self.states) > STATES:
            self._clear()
        length = np.minimum(ends - starts, self.depth)
        order = np.argsort(-length, kind="stable")
        start, length = starts[order], length[order]
        at = np.zeros(len(start), np.int64)
        for t in range(self.depth):
            m = int(np.searchsorted(-length, -t, side="left"))
            if not m:
                break
            read = symbols[start[:m] + t]
            after = self.table[at[:m], read]
            for cell in np.unique((at[:m] * self.width + read)[after < 0]).tolist():
                state, k = divmod(cell, self.width)
                number = self._step(state, k)
                self.table[state, k] = number
            at[:m] = self.table[at[:m], read]
        out = np.empty(len(start), np.int8)
        out[order] = self.best[at]
        return out


FEATURES = 5


def features(texts: pa.Array, lookup: Lookup) -> np.ndarray:
    """Per text: abuse by exact and by misspelled terms, the same in quotation, and density."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).to_pylist()
    points, offsets = code_points(lower)
    starts, ends, at = spans(lookup.alnum[points], offsets)
    out = np.zeros((len(lower), FEATURES))
    if not len(starts) or not lookup.depth:
        return out
    edits = lookup.edits(lookup.symbol[points], starts, ends)
    hits = np.flatnonzero(edits < 9)
    for i, d in zip(hits.tolist(), (np.searchsorted(at, hits, side="right") - 1).tolist()):
        text, base = lower[d], offsets[d]
        first, last = max(i - AROUND, at[d]), min(i + AROUND, at[d + 1] - 1)
        around = {text[starts[j] - base : ends[j] - base] for j in range(first, last + 1) if j != i}
        place = starts[i] - base
        line = text[text.rfind("\n", 0, place) + 1 : place]
        quoted = sum(line.count(q) for q in QUOTES) % 2 == 1 or bool(around & REPORTING)
        weight = 1.5 if around & ADDRESS else 1.0
        out[d, (2 if quoted else 0) + (edits[i] > 0)] += weight
    n = np.maximum(np.diff(at), 1)
    out[:, 4] = np.sqrt(out[:, :2].sum(1) / n)
    out[:, :4] = np.log1p(out[:, :4])
    return out


PRIOR = np.array([2.0, 1.0, 0.5, 0.25, 0.0])


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, key): every different labelled text once, toxic if any of its rows is.

    Ids with CRC-32 divisible by 5, null ids, labels and texts take no part. ``key`` is the
    text's hash: copies, however many, are brought together in the tasks that read them.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic is not null")
        .filter(F.crc32(F.col("id").cast("string")) % 5 != 0)
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    rows = docs.select("doc_id", "text").filter("text is not null")
    found = rows.join(sent_if_small(known), rows["doc_id"] == known["id"])
    return (
        found.groupBy(F.xxhash64("text", F.lit(7)).alias("key"))
        .agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
        .select("text", "toxic", "key")
    )


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _beginnings(text: str) -> set[str]:
    return {w[:n] for w in set(_words(text)) for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _in_many_places(rows: DataFrame, terms: set[str]) -> set[str]:
    """Those of the terms that do not mostly stand between the same two words of ``rows(text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found: list[tuple[str, str]] = []
            for text in batch.column("text").to_pylist():
                words = ["", *_words(text), ""]
                found += {
                    (w[:n], f"{words[i]} {words[i + 2]}")
                    for i, w in enumerate(words[1:-1])
                    for n in range(SHORTEST, min(len(w), LONGEST) + 1)
                    if w[:n] in terms
                }
            columns = [pa.array([f[j] for f in found], pa.string()) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["term", "around"])

    places = rows.select("text").mapInArrow(run, "term string, around string")
    count = places.groupBy("term", "around").agg(F.count("*").alias("n"))
    most = count.groupBy("term").agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    return {r.term for r in most.filter(F.col("most") <= F.col("n") * MAX_ALIKE).collect()}


def _counted(rows: DataFrame) -> DataFrame:
    """(term, n_toxic, n_other): texts with a word that begins so, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            n = [pa.array([c[t] for t in terms], pa.int64()) for c in counts]
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), n[1], n[0]], ["term", "n_toxic", "n_other"])

        for batch in small_batches(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic == 1].update(_beginnings(text))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield out()
                counts = (Counter(), Counter())
        yield out()

    counted = rows.select("text", "toxic").mapInArrow(run, "term string, n_toxic long, n_other long")
    return counted.groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))


def learn_lexicon(rows: DataFrame) -> list[str]:
    """Beginnings of words that tell toxic texts from others, each as long as it may be.

    All texts of ``rows(text, toxic)`` count, and terms are chosen where they are counted: the
    driver gets the telling ones, and those a little less telling that these may grow into. Those
    that mostly stand between the same two words come from copies and are left out. A term
    without a shorter one is lengthened as long as one letter goes on in nearly all of its texts.
    """
    n_toxic, n_other = (
        rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first() or (0, 0)
    )
    if not n_toxic or not n_other:
        return []
    support = max(3.0, EVIDENCE / np.log1p(n_other / n_toxic))
    ratio = (F.col("n_toxic") / n_toxic) / ((F.col("n_other") + 0.5) / n_other)
    telling = (F.col("n_toxic") >= support) & (ratio >= MIN_RATIO)
    nearly = (F.col("n_toxic") >= support / 2) & (ratio >= MIN_RATIO / 2)
    found = _counted(rows).filter(nearly).select("term", "n_toxic", telling.alias("telling")).collect()
    often = {r.term: r.n_toxic for r in found}
    chosen = _in_many_places(rows.filter("toxic = 1"), {r.term for r in found if r.telling})
    roots = {t for t in chosen if not any(t[:n] in chosen for n in range(SHORTEST, len(t)))}
    longer: dict[str, list[str]] = {}
    for t in often:
        longer.setdefault(t[:-1], []).append(t)
    terms = []
    for t in roots:
        while nexts := [x for x in longer.get(t, ()) if often[x] >= 0.95 * often[t]]:
            t = max(nexts)
        terms.append(t)
    return sorted(terms)


def scores(texts: pa.Array, model: dict) -> np.ndarray:
    if "lookup" not in model:
        model["lookup"] = Lookup(model["terms"])
    x = features(texts, model["lookup"])
    return sigmoid(x @ model["weights"][:-1] + model["weights"][-1])


def learn_toxicity(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon and weights; without labels of both kinds no terms and a score near 0."""
    rows = written(labelled_texts(docs, labels), "toxic-rows")
    terms = learn_lexicon(rows)
    if not terms:
        return {"terms": [], "weights": np.append(PRIOR, -3.0)}
    share = min(1.0, TRAIN_ROWS / rows.count())
    sample = rows.filter(F.pmod("key", F.lit(1_000_003)) < F.lit(int(share * 1_000_003)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(terms)
        for batch in small_batches(batches):
            x = features(batch.column("text"), lookup)
            columns = [pa.array(x[:, j]) for j in range(FEATURES)]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("toxic")], [*(f"x{j}" for j in range(FEATURES)), "toxic"]
            )

    kinds = ", ".join(f"x{j} double" for j in range(FEATURES))
    found = sample.select("text", "toxic").mapInArrow(run, f"{kinds}, toxic int")
    data = np.array(sorted(found.collect()), float).reshape(-1, FEATURES + 1)
    return {"terms": terms, "weights": fit_logistic(data[:, :-1], data[:, -1], PRIOR)}


def toxicity_score(text: Column, model: Broadcast) -> Column:
    """The score of a text, 0 to 1; null and empty texts have that of a text without matches."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [
            scores(batch.column("text"), model.value)
            for batch in small_batches(iter([pa.RecordBatch.from_arrays([column], ["text"])]))
        ]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return score(text)
