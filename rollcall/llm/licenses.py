"""Licence notices: a trained paragraph classifier, confirmed by comparison with templates.

The classifier is a softmax regression over 1- to 3-word features of a paragraph (a line of the
text, or adjacent lines over which a notice is wrapped), trained here on variations of the
templates below and on paragraphs of the corpus for the unknown class. Its probabilities are calibrated by a temperature on variations set aside. A
paragraph counts as a notice of a family if that is likelier than not and a template of the
family is found in it. Features that no template has carry no weight for a family, so only
paragraphs that share two words in a row with a template need the classifier.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, span_hashes, spans, text_bytes, windows
from .logistic import fit_softmax, softmax

# How licences ask to be named, by family.
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
    "unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]

#: Variations of each template, and paragraphs of the corpus, that the classifier learns from.
VARIATIONS = 40
NEGATIVES = 1_500
#: Share of a template's word pairs that a paragraph must hold in a row's order to confirm it.
CONFIRMED = 0.6


def words(paragraph: str) -> list[str]:
    return re.findall(r"[^\W_]+", paragraph.lower())


def grams(w: list[str], sizes: tuple[int, ...] = (1, 2, 3)) -> list[str]:
    return [" ".join(w[i : i + n]) for n in sizes for i in range(len(w) - n + 1)]


PAIRS = {
    family: [set(grams(words(t), (2,))) for t in templates] for family, templates in TEMPLATES.items()
}

#: The pairs of every template, in the order of families.
ALL_PAIRS = [pairs for family in PAIRS.values() for pairs in family]
#: Words that mark a comment line; other marks are no words.
_MARK = re.compile(r"^\W*(?:rem|dnl)\b", re.IGNORECASE)


def similarity(paragraph: str, family: str) -> float:
    """The largest share of a template's word pairs that the paragraph has."""
    own = set(grams(words(paragraph), (2,)))
    return max(len(own & pairs) / len(pairs) for pairs in PAIRS[family])


class Classifier:
    """Features that templates have, one weight each and family, and a temperature."""

    def __init__(self, place: dict[str, int], weights: np.ndarray, temperature: float) -> None:
        self.place, self.weights, self.temperature = place, weights, temperature

    def features(self, w: list[str]) -> np.ndarray:
        out = np.zeros(len(self.place) + 2)
        out[[self.place[g] for g in grams(w) if g in self.place]] = 1
        out[:-2] /= max(np.sqrt(out.sum()), 1)
        out[-2] = 1
        out[-1] = len(w) == 0
        return out

    def judge(self, paragraph: str) -> tuple[str, float, float]:
        """Family or ``unknown``, its probability, and how much of a template is there."""
        p = softmax((self.features(words(paragraph)) @ self.weights / self.temperature)[None])[0]
        best = int(p.argmax())
        family = FAMILIES[best]
        if family == UNKNOWN:
            return UNKNOWN, float(p[best]), 0.0
        found = similarity(paragraph, family)
        if p[best] < 0.5 or found < CONFIRMED:
            return UNKNOWN, float(p[-1]), found
        return family, float(p[best]), found


def train(negatives: list[str], seed: int = 8) -> dict:
    """Arguments of a ``Classifier``, learned from templates and from paragraphs without a notice."""
    chance = random.Random(seed)
    unknown = FAMILIES.index(UNKNOWN)
    negatives = [p for p in negatives if max(similarity(p, f) for f in TEMPLATES) < CONFIRMED]
    fill = [w for p in negatives[:200] for w in words(p)] or ["a"]
    data: list[tuple[list[str], int]] = [(words(p)[:60], unknown) for p in negatives] + [([], unknown)]
    for family, templates in TEMPLATES.items():
        for template in templates:
            for i in range(VARIATIONS):
                w = [x for x in words(template) if not i or chance.random() > 0.06]
                around = [chance.choice(fill) for _ in range(chance.choice((0, 0, 2, 5, 15, 30)) if i else 0)]
                cut = chance.randint(0, len(around))
                data.append((around[:cut] + w + around[cut:], FAMILIES.index(family)))
                # a piece of a notice that says nothing of its family is unknown
                if i % 4 == 0 and len(w) > 3:
                    data.append((around + w[: len(w) // 3], unknown))
    names = sorted({g for t in TEMPLATES.values() for x in t for g in grams(words(x))})
    blank = Classifier({g: i for i, g in enumerate(names)}, np.empty(0), 1.0)
    x = np.stack([blank.features(w) for w, _ in data])
    y = np.array([c for _, c in data])
    aside = np.arange(len(y)) % 5 == 0
    weights = fit_softmax(x[~aside], y[~aside], len(FAMILIES))
    logits = x[aside] @ weights
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(aside.sum()), y[aside]] + 1e-12).mean()
    temperature = min((0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0), key=loss)
    return {"place": blank.place, "weights": weights, "temperature": temperature}


def negative_paragraphs(docs: DataFrame, rows: int = NEGATIVES) -> list[str]:
    """A paragraph each of up to ``rows`` documents, both chosen by hash."""
    ids = docs.select("doc_id").filter("doc_id is not null")
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(rows).distinct()
    chosen = docs.join(F.broadcast(ids), "doc_id").filter("text is not null")
    lines = F.split("text", "\n", -1)
    pick = F.get(lines, F.pmod(F.xxhash64("doc_id", F.lit(9)), F.size(lines)).cast("int"))
    found = chosen.select("doc_id", F.substring(pick, 1, 2000).alias("p")).collect()
    return [r.p for r in sorted(found, key=lambda r: (r.doc_id, r.p))]


def _pair_hashes() -> tuple[np.ndarray, list[list[int]]]:
    """Hashes of all word pairs of the templates, as ``candidates`` sees them, and the templates of each."""
    rows = [(p, i) for i, pairs in enumerate(ALL_PAIRS) for p in sorted(pairs)]
    data, offsets = text_bytes(pa.array([p for p, _ in rows]))
    starts, ends, at = spans(_LETTERS[data], offsets)
    values, place = np.unique(windows(span_hashes(data, starts, ends), at, 2)[0], return_inverse=True)
    owners: list[list[int]] = [[] for _ in values]
    for (_, i), at_value in zip(rows, place.tolist()):
        owners[at_value].append(i)
    return values, owners


_LETTERS = np.zeros(256, bool)
_LETTERS[0x80:] = True
_LETTERS[[c for c in range(128) if chr(c).isalnum()]] = True


def candidates(
    column: pa.Array, pairs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[str], list[set[int]]]:
    """Text, number, paragraph and found pairs of all lines where a word pair of ``pairs`` begins.

    Words here are runs of ASCII letters and digits and of all other characters; a template
    has ASCII words only, and its pairs are met wherever the classifier's own words meet them,
    but where a sign beyond ASCII touches them. The second word may be on a later line.
    """
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, at = spans(_LETTERS[data], offsets)
    values, first = windows(span_hashes(data, starts, ends), at, 2)
    place = np.minimum(np.searchsorted(pairs, values), len(pairs) - 1)
    good = pairs[place] == values
    hit, place = starts[first[good]], place[good]
    p_start, p_end, p_at = spans(data != 10, offsets)
    own, row = np.unique(np.searchsorted(p_start, hit, side="right") - 1, return_inverse=True)
    found: list[set[int]] = [set() for _ in own]
    for r, p in zip(row.tolist(), place.tolist()):
        found[r].add(p)
    text = np.searchsorted(p_at, own, side="right") - 1
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    number = breaks[p_start[own]] - breaks[offsets[text]]
    lines = [data[p_start[i] : p_end[i]].tobytes().decode("utf-8", "replace") for i in own]
    return text, number, lines, found


def chains(
    text: np.ndarray, number: np.ndarray, found: list[set[int]], owners: list[list[int]]
) -> list[tuple[int, int, int]]:
    """(first, lines, template): adjacent candidates that may hold a wrapped template.

    Every line of a chain begins pairs of the template that no line before it in the chain does, so
    that a chain is no longer than its template. The line after the last may end the notice.
    """
    out = []
    t, n = text.tolist(), number.tolist()
    own: list[dict[int, set[int]]] = []
    for pairs in found:
        split: dict[int, set[int]] = {}
        for p in pairs:
            for i in owners[p]:
                split.setdefault(i, set()).add(p)
        own.append(split)
    for i in range(len(t)):
        for template, held in own[i].items():
            held, j = set(held), i + 1
            while j < len(t) and t[j] == t[i] and n[j] == n[i] + j - i:
                more = own[j].get(template)
                if not more or more <= held:
                    break
                held |= more
                j += 1
            # marks such as rem stand between the words of two lines and part their pair
            if len(held) + j - i >= CONFIRMED * len(ALL_PAIRS[template]):
                out.append((i, j - i, template))
    return out


def wrapped(lines: list[str], template: int) -> list[str]:
    """The fewest of ``lines``, from the first on, that hold as much of the template as all of them."""
    pairs, held, best, joined = ALL_PAIRS[template], 0, 1, ""
    for count, line in enumerate(lines, 1):
        stripped = _MARK.sub(" ", line)
        if not words(stripped):
            break
        joined += " " + stripped
        now = len(pairs & set(grams(words(joined), (2,))))
        if now > held:
            held, best = now, count
    return [_MARK.sub(" ", x) for x in lines[:best]]


Notice = tuple[int, int, str, float, float]


def notices_of(
    lines: list[str], singles: dict[int, tuple[str, float, float]], spans_: list[tuple[int, int, int]], judge
) -> list[Notice]:
    """(first line, lines, family, probability, similarity) of one text's notices, none overlapping.

    ``singles`` are lines that are notices by themselves, ``spans_`` chains of a template. What
    holds more of a template comes first, then the shorter. A span takes in a line that is a notice of
    another family only if that line holds as much of the span's template as of its own.
    """
    found: list[Notice] = [(n, 1, *s) for n, s in singles.items()]
    for first, count, template in spans_:
        part = wrapped(lines[first : first + count + 1], template)
        if len(part) < 2:
            continue
        family, probability, share = judge(" ".join(part))
        if family == UNKNOWN:
            continue
        kept = True
        for n in range(first, first + len(part)):
            if n in singles and singles[n][0] != family:
                held = set(grams(words(lines[n]), (2,)))
                most = lambda f: max(len(held & pairs) for pairs in PAIRS[f])
                kept = kept and most(family) >= most(singles[n][0])
        if kept:
            found.append((first, len(part), family, probability, share))
    taken: set[int] = set()
    out = []
    for notice in sorted(found, key=lambda x: (-x[4], x[1], x[0], -x[3])):
        own = set(range(notice[0], notice[0] + notice[1]))
        if not own & taken:
            taken |= own
            out.append(notice)
    return sorted(out)


def license_notices(docs: DataFrame, model: Broadcast) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity): every notice found in ``docs(doc_id, text)``.

    ``paragraph`` counts the lines of the text from 0; a notice wrapped over adjacent lines has the
    number of its first. Texts without a notice, null and empty
    ones too, give no row; repeated rows give theirs each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier, (pairs, owners) = Classifier(**model.value), _pair_hashes()
        for batch in small_batches(batches):
            column = batch.column("text")
            text, number, paragraphs, found = candidates(column, pairs)
            judged = {p: classifier.judge(p) for p in set(paragraphs)}
            single: dict[int, dict[int, tuple[str, float, float]]] = {}
            for t, n, p in zip(text.tolist(), number.tolist(), paragraphs):
                if judged[p][0] != UNKNOWN:
                    single.setdefault(t, {})[n] = judged[p]
            span: dict[int, list[tuple[int, int, int]]] = {}
            for i, count, template in chains(text, number, found, owners):
                span.setdefault(int(text[i]), []).append((int(number[i]), count, template))
            rows = []
            for t in sorted({*single, *span}):
                lines = column[t].as_py().split("\n") if t in span else []
                own = notices_of(lines, single.get(t, {}), span.get(t, []), classifier.judge)
                rows += [(t, n, *rest) for n, _, *rest in own]
            text, number, family, probability, share = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text, pa.int64())),
                    pa.array(number, pa.int64()), pa.array(family, pa.string()),
                    pa.array(probability, pa.float64()), pa.array(share, pa.float64()),
                ],
                ["doc_id", "paragraph", "family", "probability", "similarity"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, paragraph long, family string, probability double, similarity double"
    )


def learn_licenses(docs: DataFrame) -> dict:
    """The classifier's arguments, trained on templates and a bounded sample of paragraphs."""
    return train(negative_paragraphs(docs))
