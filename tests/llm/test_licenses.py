import random
import textwrap

import pytest

from rollcall.llm import licenses as lc


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    vocabulary = "the of and to in under work this is version free software public general time law terms".split()
    return lc.train([" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 40))) for _ in range(300)])


def test_templates_and_variations(model):
    classifier = lc.Classifier(**model)
    for family, templates in lc.TEMPLATES.items():
        for t in templates:
            assert classifier.judge(t)[0] == family, t
            assert classifier.judge("Some words before: " + t.upper() + " and more after it")[0] == family, t
    for text in ("", "I lost my license under the general public", "version 2.0 of this software is free", "all rights"):
        assert classifier.judge(text)[0] == lc.UNKNOWN


def test_odd_rows(spark, odd_docs, no_docs, model):
    shared = spark.sparkContext.broadcast(model)
    assert lc.license_notices(odd_docs, shared).count() == 0
    assert lc.license_notices(no_docs, shared).count() == 0
    rows = [(1, "a\n\nReleased under the MIT License.\nb"), (1, "a\n\nReleased under the MIT License.\nb"),
            (None, "All rights reserved."), (3, "É licensed under the Apache License, Version 2.0\nAll rights reserved.")]
    got = lc.license_notices(spark.createDataFrame(rows, "doc_id long, text string"), shared).collect()
    assert sorted((str(r.doc_id), r.paragraph, r.family) for r in got) == [
        ("1", 2, "mit"), ("1", 2, "mit"), ("3", 0, "apache-2.0"), ("3", 1, "proprietary"), ("None", 0, "proprietary"),
    ]
    assert lc.negative_paragraphs(odd_docs) and lc.negative_paragraphs(no_docs) == []


def test_whole_table(spark, corpus):
    """Every line of the corpus that names a licence in the templates' words, and no other."""
    docs = corpus("0.01")[0]
    got = {(r.doc_id, r.paragraph) for r in lc.license_notices(docs, spark.sparkContext.broadcast(lc.learn_licenses(docs))).collect()}
    known = [t for ts in lc.TEMPLATES.values() for t in ts]
    want = {(r.doc_id, n) for r in docs.collect() for n, line in enumerate((r.text or "").split("\n")) if any(t in line for t in known)}
    assert got == want


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "REM ", "dnl "])
@pytest.mark.parametrize("width", [24, 40, 72])
def test_wrapped_templates(spark, model, mark, width):
    """Every template wrapped as headers are, between other lines: one row, at its first line."""
    rows, want = [], []
    for family, templates in lc.TEMPLATES.items():
        for t in templates:
            own = textwrap.wrap(t, width, break_on_hyphens=False, break_long_words=False)
            text = ["int zero = 0;", "", *(mark + x for x in own), mark.strip(), "some other words follow here"]
            want.append((len(rows), 2, family))
            rows.append((len(rows), "\n".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lc.license_notices(df, spark.sparkContext.broadcast(model)).collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got) == want
