import numpy as np
from pyspark.sql import functions as F

from rollcall.llm import cotraining as ct
from rollcall.llm.queries import op2_cotrained_quality

COLUMNS = ("text", "source", "lang", "n_chars")


def test_held_out(spark, corpus):
    docs, labels, _ = corpus("0.01")
    scored = op2_cotrained_quality(spark, "/root/testdata/sf0.01")
    rows = scored.join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert scored.count() == 1000 and np.mean(good) > 0.9 and np.mean(bad) < 0.5


def test_views_teach_one_another():
    """Few labels, two views that are each sure of other rows: the pool lifts both."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1200)
    a = np.stack([(2 * y - 1) * rng.exponential(2, 1200), rng.normal(size=1200)], 1)
    b = np.stack([(2 * y - 1) * rng.exponential(2, 1200), rng.normal(size=1200)], 1)
    seen = np.where(np.arange(1200) < 24, y, -1)
    model = ct.co_train(a, b, seen)
    both = sum(ct._logit(x, w) * s[0] + s[1] for x, w, s in zip((a, b), model["weights"], model["scale"]))
    assert np.mean((both > 0) == y) > 0.97


def test_odd_rows_and_no_labels(spark, odd_docs, no_docs):
    for labels, share in (([], 0.5), ([(1, 1), (6, 1)], 1.0), ([(1, 1), (6, 0), (8, 0), (11, 1), (7, 0)], None)):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        model = spark.sparkContext.broadcast(ct.learn_quality(odd_docs, frame))
        score = ct.quality_scores(*map(F.col, COLUMNS), model)
        rows = odd_docs.select(score.alias("q")).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.q.score <= 1 for r in rows)
        if share is not None:
            assert {r.q.score for r in rows} == {share}
    assert no_docs.select(score).count() == 0
