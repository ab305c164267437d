import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from rollcall.llm.oracle import ORACLE
from rollcall.llm.queries import QUERIES


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf_dir, name):
    with connect(sf_dir) as con:
        assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None
