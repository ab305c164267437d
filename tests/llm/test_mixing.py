import pytest
from pyspark.sql import functions as F

from rollcall.llm import mixing as m


def mixed(df):
    key = m.sampling_key(F.col("doc_id"), F.col("text"), m.quality_weight(F.col("text")), "s")
    sized = df.withColumn("size", m.words_in(F.col("text"))).withColumn("key", key)
    return m.mix_sources(sized)


def test_targets_stop_and_excess_is_shared(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in m.source_targets(totals).collect()}
    # weights a 5, b 2, c 1, null 5; a stops at 30 and c at 0, b and null share 1480 by 2 and 5
    assert got == {"a": 30.0, "c": 0.0, "b": pytest.approx(1480 * 2 / 7), None: pytest.approx(1480 * 5 / 7)}
    assert m.source_targets(totals.limit(0)).count() == 0


def test_odd_rows(odd_docs):
    rows = mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(rows[0].asDict()) == sorted([*odd_docs.columns, "source_size", "target", "taken"])
    assert sum(r.size for r in rows) == pytest.approx(sum({r.source: r.target for r in rows}.values()))
    for r in rows:
        assert r.taken == 0 if not r.size else r.taken % r.size == 0 and r.taken <= 3 * r.size
    again = sorted(str(r.asDict()) for r in mixed(odd_docs).collect())
    assert again == sorted(str(r.asDict()) for r in rows)


def test_empty_table(no_docs):
    assert mixed(no_docs).count() == 0


def test_taken_is_near_target(corpus):
    rows = mixed(corpus("0.01")[0]).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1
        epochs = own[0].target // own[0].source_size
        assert {r.taken // r.size for r in own if r.size} <= {epochs, epochs + 1}


def test_heavier_documents_come_first(spark):
    """A weight of 1 against 1/9 decides who is taken; both kinds have the same sizes."""
    rows = [(i, "a", 1, 1.0 if i % 2 else 1 / 9) for i in range(4000)]
    df = spark.createDataFrame([*rows, (9999, "b", 2000, 1.0)], "doc_id long, source string, size long, w double")
    key = m.sampling_key(F.col("doc_id"), F.lit("t"), F.col("w"), "s")
    taken = m.mix_sources(df.withColumn("key", key)).filter("source = 'a'").collect()
    extra = [r for r in taken if r.taken > min(x.taken for x in taken)]
    assert len(extra) and sum(r.w == 1.0 for r in extra) > 0.7 * len(extra)


@pytest.mark.parametrize("weight", [1.0, 1 / 3, 1 / 6, 1e-6, 50.0])
def test_no_bin_grows_with_the_weight(spark, weight):
    """A source of one low weight is spread over as many bins as any other; equal keys share one."""
    key = m.sampling_key(F.col("id"), F.lit("t"), F.lit(weight), "s")
    bins = spark.range(200_000).select(m._bin(key).alias("b")).groupBy("b").count()
    assert bins.agg(F.max("count")).first()[0] < 200_000 / 1000
    edges = spark.createDataFrame([(0.0,), (-0.0,), (1e-17,), (40.0,)], "k double").select(m._bin(F.col("k")).alias("b"))
    got = [r.b for r in edges.collect()]
    assert got[0] == got[1] < got[2] < got[3]
