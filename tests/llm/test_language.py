import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import language as lg
from rollcall.llm.queries import op10_language_id


def phrases(text, sample):
    """Longest matches from left to right, by substring search, block by block."""
    count = 0
    for b in range(0, len(text), lg.BLOCK):
        block, i = text[b : b + lg.BLOCK], 0
        while i < len(block):
            n = 1
            while i + n < len(block) and block[i : i + n + 1] in sample:
                n += 1
            count, i = count + 1, i + n
    return count


@settings(deadline=None, max_examples=100)
@given(st.text("abc", min_size=1, max_size=40), st.lists(st.text("abcd", max_size=700), min_size=1, max_size=4))
def test_parse_equals_substring_search(sample, texts):
    parser = lg.Parser({"x": sample})
    parser.build()
    points, offsets = lg.code_points(texts)
    columns, text = lg.side_by_side(parser.symbol[points].astype("int64"), offsets)
    found = [0] * len(texts)
    for t, n in zip(text.tolist(), parser.phrases("x", columns, len(text)).tolist()):
        found[t] += n
    assert found == [phrases(t, sample) for t in texts]


def test_held_out_accuracy(spark, corpus):
    rows = op10_language_id(spark, "/root/testdata/sf0.01").join(corpus("0.01")[0].select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n > 40]
    assert len(rows) == 1000 and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    samples = lg.language_samples(odd_docs)
    model = spark.sparkContext.broadcast({"samples": samples})
    rows = odd_docs.select("text", lg.language_of(F.col("text"), model).alias("l")).collect()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.l.lang_pred != "und") == letters and 0 <= r.l.score <= 1
    assert lg.language_samples(no_docs) == {}
    assert lg.identify(pa.array(["abc"]), lg.Parser({})) [0] == ["und"]
    assert no_docs.select(lg.language_of(F.col("text"), model)).count() == 0
