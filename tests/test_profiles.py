import json
import uuid

import pytest
from pyspark.errors import PySparkException

from checks import tables as t
from rollcall.operators import flatten_profiles, split_profiles
from rollcall.schema import USER_FIELDS
from rollcall.sources import read_raw_profiles, rejected_responses

PROFILE = {
    "name": {"title": "Ms", "first": "Ada", "last": "L"},
    "gender": "female",
    "location": {
        "street": {"number": 12, "name": "Main St"},
        "city": "Lyon",
        "state": "Rhône",
        "country": "France",
        "postcode": 69001,
        "coordinates": {"latitude": "1"},
    },
    "email": "ada@example.com",
    "login": {"username": "ada", "password": "x"},
    "dob": {"date": "1990-02-03T04:05:06.789Z", "age": 34},
    "registered": {"date": "2010-02-03T04:05:06.789Z"},
    "phone": "1",
    "picture": {"large": "l", "medium": "m"},
}


def land(tmp_path, *responses, indent=None):
    folder = tmp_path / "landed"
    folder.mkdir()
    for i, response in enumerate(responses):
        text = response if isinstance(response, str) else json.dumps(response, indent=indent)
        (folder / f"{i}.json").write_text(text + "\n")
    return str(folder)


def test_flatten(spark, tmp_path):
    path = land(tmp_path, {"results": [PROFILE], "info": {"seed": "s"}})
    users = flatten_profiles(read_raw_profiles(spark, path))
    assert users.columns == list(USER_FIELDS)
    row = users.first().asDict()
    assert uuid.UUID(row.pop("id")).version == 4
    assert list(row.values()) == [
        "Ada", "L", "female", "12 Main St, Lyon, Rhône, France", "69001", "ada@example.com", "ada",
        "1990-02-03T04:05:06.789Z", "2010-02-03T04:05:06.789Z", "1", "m",
    ]


def test_only_the_first_result_is_taken(spark, tmp_path):
    other = {**PROFILE, "email": "other"}
    path = land(tmp_path, {"results": [PROFILE, other]}, {"results": [other, PROFILE]})
    emails = [r.email for r in read_raw_profiles(spark, path).collect()]
    assert sorted(emails) == ["ada@example.com", "other"]


def test_pretty_printed_files(spark, tmp_path):
    path = land(tmp_path, {"results": [PROFILE]}, {"results": [PROFILE]}, indent=2)
    assert read_raw_profiles(spark, path, whole_files=True).count() == 2


def test_responses_without_a_profile(spark, tmp_path):
    bad = ['{"results":[]}', '{"error":"slow down"}', "<html>"]
    path = land(tmp_path, {"results": [PROFILE]}, *bad, "")
    assert read_raw_profiles(spark, path).count() == 1
    assert sorted(r.value for r in rejected_responses(spark, path).collect()) == sorted(bad)
    with pytest.raises(PySparkException, match="response without a profile"):
        read_raw_profiles(spark, path, strict=True).collect()


def test_strict_lets_good_responses_pass(spark, tmp_path):
    path = land(tmp_path, {"results": [PROFILE]})
    assert read_raw_profiles(spark, path, strict=True).first().email == "ada@example.com"


def test_address_lacking_a_part(spark, tmp_path):
    holed = json.loads(json.dumps(PROFILE))
    holed["location"]["state"] = None
    missing = json.loads(json.dumps(PROFILE))
    del missing["location"]["street"]["number"]
    path = land(tmp_path, {"results": [PROFILE]}, {"results": [holed]}, {"results": [missing]})
    whole, lacking = split_profiles(flatten_profiles(read_raw_profiles(spark, path)))
    assert whole.count() == 1
    assert [r.address for r in lacking.collect()] == [None, None]


def test_random_ids_differ_and_hashed_ids_repeat(spark, sf_dir):
    profiles = t.profiles(spark, sf_dir)
    ids = [r.id for r in flatten_profiles(profiles).select("id").collect()]
    assert len(set(ids)) == len(ids)
    once = flatten_profiles(profiles, ["login.username"]).select("id").collect()
    twice = flatten_profiles(profiles.repartition(5), ["login.username"]).select("id").collect()
    assert sorted(once) == sorted(twice)
    assert len(set(once)) == len(ids)


def test_landed_stream(spark, tmp_path):
    path = land(tmp_path, {"results": [PROFILE]}, {"results": [PROFILE]})
    users = flatten_profiles(read_raw_profiles(spark, path, stream=True))
    query = (
        users.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "users"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "users")).select("id").distinct().count() == 2
