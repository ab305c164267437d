import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import quality as q


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(again),
    )


def judged(df, references=None, limits=q.Limits()):
    references = q.language_references(df, limits) if references is None else references
    rows = df.select("text", q.quality_verdict(F.col("text"), references, limits).alias("q")).collect()
    return [(r.text, r.q) for r in rows]


def test_base_counts(spark, odd_docs):
    more = ["a b c d e f g h " * 3 + "x", "same line\nsame line\n \n\nsame line", "#*$%&|<> é #", "x\n" * 30]
    df = odd_docs.select("text", "lang").unionByName(spark.createDataFrame([(t, "en") for t in more], "text string, lang string"))
    rows = judged(df)
    assert len(rows) == df.count()
    for text, v in rows:
        counts = base(text)
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == counts
        assert v.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (v.kept and v.base_failed)


def test_empty_table_and_no_references(no_docs, odd_docs):
    assert q.language_references(no_docs) == {}
    assert judged(no_docs) == []
    for _, v in judged(odd_docs, {}):
        assert v.char_distance is None and v.kept == (not v.base_failed)


def test_junk_is_told_from_prose(corpus):
    docs, labels, _ = corpus("0.01")
    references = q.language_references(docs)
    assert set(references) == {"de", "en", "es", "fr"}
    rows = docs.join(labels, "doc_id").withColumn("v", q.quality_verdict(F.col("text"), references)).collect()
    clean = [r.v.kept for r in rows if r.quality == 1 and not r.v.base_failed]
    junk = [r.v.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.3


@pytest.mark.parametrize("p, distance", [([1.0, 0.0], 0.0), ([0.0, 1.0], 1.0)])
def test_js_distance(p, distance):
    assert q.js_distance(np.array([p]), np.array([1.0, 0.0]))[0] == pytest.approx(distance)


def test_words_of_equal_count_do_not_pile_up(spark):
    """A language of words that all differ has no common word; ties at the last place are left out together."""
    flat = " ".join(f"w{i}" for i in range(5000))
    tied = " ".join(f"t{i}" for i in range(60)) + " " + " ".join(f"u{i % 40}" for i in range(4000))
    df = spark.createDataFrame([(flat, "xx"), (tied, "yy"), ("too few words", "zz")], "text string, lang string")
    got = q.language_references(df)
    assert set(got) == {"xx", "yy"}
    assert got["xx"]["words"] == {} and len(got["yy"]["words"]) == 40
    assert len(judged(df, got)) == 3
