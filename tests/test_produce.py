import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rollcall.operators import encode_users
from rollcall.plans import run_produce, run_rejects
from rollcall.schema import USER_FIELDS, message_schema
from rollcall.sources import latest_users, write_user_messages
from rollcall.sources.messages import kafka_target
from rollcall.streaming import run_ingest
from tests.test_profiles import PROFILE


def land(folder, name, *emails, **change):
    folder.mkdir(exist_ok=True)
    profiles = [{**PROFILE, "email": email, **change} for email in emails]
    lines = [json.dumps({"results": [profile]}) for profile in profiles]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_landed_to_keyed_table(spark, tmp_path):
    landed, messages, log = (tmp_path / name for name in ("landed", "messages", "log"))

    def run():
        once = {"availableNow": True}
        run_produce(
            spark, str(landed), str(messages), str(tmp_path / "c1"), "files",
            id_from=["email"], trigger=once,
        ).awaitTermination()
        run_ingest(
            spark, str(messages), str(log), str(tmp_path / "c2"), "files", trigger=once
        ).awaitTermination()
        users = latest_users(spark, str(log), "files", ["email", "phone"])
        return {r.email: r.phone for r in users.collect()}

    land(landed, "1.json", "a", "b")
    assert run() == {"a": "1", "b": "1"}
    assert run() == {"a": "1", "b": "1"}
    assert spark.read.schema(message_schema("files")).parquet(str(messages)).count() == 2
    land(landed, "2.json", "b", "c", phone="2")
    assert run() == {"a": "1", "b": "2", "c": "2"}


def test_incomplete_profiles_are_not_published(spark, tmp_path):
    land(tmp_path / "landed", "1.json", "a")
    land(tmp_path / "landed", "2.json", "b", location={"city": "Lyon"})
    (tmp_path / "landed" / "3.json").write_text('{"results":[]}\n')
    run_produce(
        spark, str(tmp_path / "landed"), str(tmp_path / "messages"), str(tmp_path / "c"), "files",
        trigger={"availableNow": True},
    ).awaitTermination()
    values = spark.read.parquet(str(tmp_path / "messages")).collect()
    assert [json.loads(bytes(r.value))["email"] for r in values] == ["a"]


def test_messages_without_order_get_the_time(spark, tmp_path):
    users = spark.range(2).select(*[F.lit("x").alias(c) for c in USER_FIELDS])
    write_user_messages(encode_users(users), str(tmp_path / "m"), "files")
    stored = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(stored.columns) == ["seq", "value"]
    now = "timestamp_micros(seq) between current_date() - 1 and current_date() + 2"
    assert stored.where(now).count() == 2


def test_topic_options():
    assert kafka_target("b:1") == {"kafka.bootstrap.servers": "b:1", "topic": "users_created"}


def test_rejects_and_strictness(spark, tmp_path):
    """What is not published is kept with its reason; a missing id path is one; strict fails."""
    land(tmp_path / "landed", "1.json", "a")
    land(tmp_path / "landed", "2.json", "b", login=None)
    land(tmp_path / "landed", "3.json", "c", gender=None)
    (tmp_path / "landed" / "4.json").write_text('{"results":[]}\nnot json\n')
    how = {"id_from": ["login.username"], "trigger": {"availableNow": True}}
    landed, messages, rejected = (str(tmp_path / n) for n in ("landed", "messages", "rejected"))
    run_produce(spark, landed, messages, str(tmp_path / "c1"), "files", **how).awaitTermination()
    run_rejects(spark, landed, rejected, str(tmp_path / "c2"), **how).awaitTermination()
    values = spark.read.parquet(messages).collect()
    assert sorted(json.loads(bytes(r.value))["email"] for r in values) == ["a", "c"]
    reasons = sorted(r.reason for r in spark.read.parquet(rejected).collect())
    assert reasons == ["no id; no login.username", "no profile", "no profile"]
    query = run_produce(
        spark, landed, str(tmp_path / "m2"), str(tmp_path / "c3"), "files", strict=True, **how
    )
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
