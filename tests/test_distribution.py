import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import (
    age_distribution,
    city_distribution,
    country_distribution,
    daily_distributions,
    gender_distribution,
    rejected_for_analysis,
    share,
    with_address_part,
)
from rollcall.schema import AGE_LABELS, RESULT_SCHEMA

AS_OF = t.AS_OF


def as_dict(df):
    return {r.category: r.percentage for r in df.collect()}


def users_of(spark, rows):
    rows = [(str(i), *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(rows, "id string, gender string, address string, dob string")


def test_share_like_pandas_to_the_last_bit(spark):
    rng = random.Random(5)
    values = rng.choices(["a", "b", "c", "", " a", None], weights=[33, 7, 1, 3, 2, 5], k=997)
    df = spark.createDataFrame([(v,) for v in values], "k string")
    assert as_dict(share(df, "k")) == dict(pd.Series(values).value_counts(normalize=True) * 100)


def test_declared_categories_like_pandas(spark):
    values = ["a", "a", "b", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    labels = ["a", "b", "c"]
    series = pd.Series(pd.Categorical(values, categories=labels))
    assert as_dict(share(df, "k", labels)) == dict(series.value_counts(normalize=True) * 100)


def test_awkward_labels(spark):
    labels = ["it's", 'a "b"', "back\\slash", ""]
    df = spark.createDataFrame([("it's",), ("back\\slash",)], "k string")
    assert as_dict(share(df, "k", labels)) == dict(zip(labels, [50.0, 0.0, 50.0, 0.0]))


def test_gender_is_taken_as_written(spark):
    df = users_of(spark, [(g, None, None) for g in ["f", None, "m", "", "f", " f"]])
    found = as_dict(gender_distribution(df, AS_OF))
    assert found == {"f": 40.0, "m": 20.0, "": 20.0, " f": 20.0}


def test_ages_outside_every_bin_do_not_count(spark):
    years = [2019, 2019, 1954, 2024, 1800]
    df = users_of(spark, [("f", "a,b", f"{y}-01-01T00:00:00.0Z") for y in years])
    assert as_dict(age_distribution(df, AS_OF)) == {
        "0-15": 66.66666666666666,
        "16-30": 0.0,
        "31-45": 0.0,
        "46-60": 0.0,
        "60+": 33.33333333333333,
    }


def test_nobody_at_all(spark):
    nobody = users_of(spark, [])
    assert as_dict(age_distribution(nobody, AS_OF)) == dict.fromkeys(AGE_LABELS)
    assert as_dict(gender_distribution(nobody, AS_OF)) == {}
    assert len(daily_distributions(nobody, AS_OF).collect()) == len(AGE_LABELS)


def test_known_result(spark):
    users = t.users(spark, "/root/testdata/sf0.01")
    assert as_dict(gender_distribution(users, AS_OF)) == {
        "female": 66.71159029649596,
        "male": 33.288409703504044,
    }
    assert as_dict(age_distribution(users, AS_OF)) == {
        "0-15": 17.07659873506676,
        "16-30": 16.163035839775123,
        "31-45": 15.95221363316936,
        "46-60": 14.898102600140547,
        "60+": 35.91004919184821,
    }


def test_one_pass_equals_four(spark, sf_dir):
    users = t.users(spark, sf_dir)
    four = (
        age_distribution(users, AS_OF)
        .unionByName(gender_distribution(users, AS_OF))
        .unionByName(city_distribution(users, AS_OF))
        .unionByName(country_distribution(users, AS_OF))
    )
    one = daily_distributions(users, AS_OF)
    assert one.columns == RESULT_SCHEMA.names
    assert sorted(one.collect()) == sorted(four.collect())


def test_shares_sum_to_100_in_any_partitioning(spark, sf_dir):
    users = t.users(spark, sf_dir)
    expected = sorted(daily_distributions(users, AS_OF).collect())
    shuffled = users.orderBy(F.rand(1)).repartition(7)
    assert sorted(daily_distributions(shuffled, AS_OF).collect()) == expected
    sums = {}
    for row in expected:
        sums[row.dimension] = sums.get(row.dimension, 0) + row.percentage
    assert all(abs(total - 100) < 1e-9 for total in sums.values())
    assert set(sums) == {"age", "gender", "city", "country"}


@pytest.mark.parametrize(
    "distribution", [daily_distributions, age_distribution, gender_distribution]
)
def test_users_are_scanned_once(spark, tmp_path, sf_dir, executed, distribution):
    path = str(tmp_path / "users")
    t.full_users(spark, sf_dir).write.parquet(path)
    plan = executed(distribution(spark.read.parquet(path), AS_OF))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 1
    assert "partial_" in plan
    assert "Window" not in plan
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "phone" not in schema and "id:" not in schema


def test_text_is_stripped_after_counting(spark, sf_dir, executed):
    df = spark.createDataFrame(
        [("a, S ,\tC",), ("b,S,C\u00a0",), ("c,\u2003S, D",), (" E ",)], "address string"
    )
    df = df.selectExpr("address", "'f' as gender", "'x' as dob")
    found = daily_distributions(df, AS_OF)
    shares = {(r.dimension, r.category): r.percentage for r in found.collect()}
    assert shares["country", "C"] == 50.0 and shares["country", "E"] == 25.0
    assert shares["city", "S"] == 100.0
    below_first_shuffle = executed(found).split("Exchange hashpartitioning")[2]
    assert "partial_count" in below_first_shuffle and "trim" not in below_first_shuffle


def test_one_scan_however_many_categories(spark, tmp_path, executed):
    path = str(tmp_path / "users")
    spark.range(0, 30000, 1, 6).selectExpr(
        "cast(id as string) as id",
        "case when id % 3 = 0 then 'hot' else cast(id as string) end as gender",
        "concat('1 A St, B, S', id, ', C') as address",
        "'1990-01-01T00:00:00.0Z' as dob",
    ).write.parquet(path)
    df = daily_distributions(spark.read.parquet(path), AS_OF)
    assert executed(df).count("FileScan parquet") == 1
    counts = {r[0]: r[1] for r in df.groupBy("dimension").count().collect()}
    assert counts == {"age": 5, "gender": 20001, "city": 30000, "country": 1}
    hot = df.where("dimension = 'gender' and category = 'hot'").first()
    assert hot.percentage == 10000 / 30000 * 100


def test_bad_rows_are_left_out_and_listed(spark):
    good, date = "1 A St, B, S, C", "1990-01-01T00:00:00.0Z"
    rows = [("f", good, date), ("f", None, date), ("f", "nocomma", "x"), ("f", good, None)]
    df = users_of(spark, rows)
    assert as_dict(city_distribution(df, AS_OF)) == {"S": 100.0}
    assert as_dict(age_distribution(df, AS_OF))["31-45"] == 100.0
    rejected = {r.id: r.reason for r in rejected_for_analysis(df).collect()}
    assert rejected == {
        "1": "no address",
        "2": "dob is not a date; address has no comma",
        "3": "no dob",
    }


@pytest.mark.parametrize(
    "address, dob", [("a, b", None), ("a, b", "1990"), (None, "1990-01-01T00:00:00.0Z")]
)
def test_strict_fails_on_a_bad_row(spark, address, dob):
    df = users_of(spark, [("f", address, dob)])
    # Both stages that wait for the failed one report it, which reaches Python as a bare error.
    with pytest.raises(Exception, match="not a birth date|address has no part"):
        daily_distributions(df, AS_OF, strict=True).collect()


def test_strict_scans_once_too(spark, sf_dir, tmp_path, executed):
    path = str(tmp_path / "users")
    t.full_users(spark, sf_dir).write.parquet(path)
    df = daily_distributions(spark.read.parquet(path), AS_OF, strict=True)
    assert executed(df).count("FileScan parquet") == 1
    assert sorted(df.collect()) == sorted(
        daily_distributions(spark.read.parquet(path), AS_OF).collect()
    )


def test_the_real_city(spark):
    df = users_of(spark, [("f", "1 A St, Lyon, Rhone, France", None)])
    assert as_dict(city_distribution(df, AS_OF)) == {"Rhone": 100.0}
    assert as_dict(city_distribution(df, AS_OF, position=-3)) == {"Lyon": 100.0}
    assert with_address_part(df, -4, "street").first().street == "1 A St"


def test_no_python_in_the_plan(spark, sf_dir, executed):
    plan = executed(daily_distributions(t.users(spark, sf_dir), AS_OF))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
