import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import toxicity as tx
from rollcall.llm.queries import op7_toxicity
from tests.llm.test_lines import plain_distance

TERMS = ["abca", "bcabcd", "cabcabcabc", "bcabce"]


def fewest(word, terms):
    """Edits from a term to some beginning of the word, if the term allows as many."""
    best = 9
    for t in terms:
        e = min(plain_distance(t, word[:n]) for n in range(len(word) + 1))
        if e <= tx.allowed_edits(t):
            best = min(best, e)
    return best


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text("abcdex", min_size=1, max_size=14), min_size=1, max_size=8))
def test_lookup_equals_edit_distance(words):
    lookup = tx.Lookup(TERMS)
    points, offsets = tx.code_points(words)
    got = lookup.edits(lookup.symbol[points], offsets[:-1], offsets[1:])
    assert got.tolist() == [fewest(w, TERMS) for w in words]


def test_context_tells_quotation_from_abuse():
    lookup = tx.Lookup(["idiot", "worthless"])
    x = tx.features(pa.array(["you idiot", "he said \"idiot\" was a word", "a worthles thing", "", None, "fine"]), lookup)
    assert x[0, 0] > 0 and x[0, 2] == 0
    assert x[1, 0] == 0 and x[1, 2] > 0
    assert x[2, 1] > 0 and x[2, 0] == 0
    assert not x[3:].any()


def test_held_out(spark, corpus):
    labels = corpus("0.01")[1]
    rows = op7_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    for held in (True, False):
        own = [r for r in rows if r.held_out == held]
        caught = [r.predicted for r in own if r.toxic == 1]
        false = [r.predicted for r in own if r.toxic == 0]
        assert sum(caught) >= 0.6 * len(caught) and sum(false) <= 0.03 * len(false)


def test_odd_rows_and_no_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = spark.sparkContext.broadcast(tx.learn_toxicity(odd_docs, labels))
    rows = odd_docs.select(tx.toxicity_score(F.col("text"), model).alias("s")).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.s < 0.5 for r in rows)
    assert no_docs.select(tx.toxicity_score(F.col("text"), model)).count() == 0
