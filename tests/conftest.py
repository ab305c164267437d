import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("tests", cpus=4, spark__sql__warehouse__dir=str(warehouse))
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def column(spark):
    """``column(values, function, type)``: the function of a column, run over the values."""

    def run(values, function, type_="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, c {type_}")
        return [r[1] for r in sorted(df.select("i", function(df.c).alias("o")).collect())]

    return run


@pytest.fixture
def executed():
    """``executed(df)``: the plan that really ran, without the initial one."""

    def run(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    return run
