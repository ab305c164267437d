import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.scratch import scratch


@pytest.fixture(scope="module")
def con():
    with connect("/root/testdata/sf0.001") as connection:
        yield connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scratch_is_taken_from_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    other = spark.newSession()
    assert scratch(other).startswith(before or "/")
    assert scratch(other) != scratch(other)
