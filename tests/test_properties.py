"""Properties that hold for any data; few examples of many rows each, as each costs a job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.operators import decode_users, encode_users, latest_by_key, share
from rollcall.schema import USER_SCHEMA

few = settings(
    max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)
# Lone surrogates are no text, and neither Arrow nor Python could hand them to Spark.
texts = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=12)


@few
@given(st.lists(st.tuples(*[texts] * len(USER_SCHEMA)), min_size=1, max_size=40))
def test_round_trip(spark, rows):
    users = spark.createDataFrame(rows, USER_SCHEMA)
    assert sorted(map(repr, decode_users(encode_users(users)).collect())) == sorted(
        map(repr, users.collect())
    )


@few
@given(st.lists(texts, max_size=200))
def test_shares(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    found = {r.category: r.percentage for r in share(df, "k").collect()}
    counted = [v for v in values if v is not None]
    assert found == {v: counted.count(v) / len(counted) * 100 for v in set(counted)}
    assert not found or abs(sum(found.values()) - 100) < 1e-9


@few
@given(st.lists(st.integers(0, 5), min_size=1, max_size=100), st.integers(1, 7))
def test_latest(spark, keys, partitions):
    rows = [(k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, o int").orderBy(F.rand(3)).repartition(partitions)
    assert {r.k: r.o for r in latest_by_key(df, ["k"], ["o"]).collect()} == dict(rows)
