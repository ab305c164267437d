from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import classify_users
from rollcall.schema import USER_FIELDS, log_schema, message_schema, order_columns
from rollcall.sources import (
    latest_users,
    read_refused,
    read_user_log,
    write_user_messages,
    written_since,
)
from rollcall.streaming import IngestProgress, kafka_options, read_user_stream, run_ingest
from rollcall.streaming.progress import lost_offsets


@pytest.fixture
def stream(spark, tmp_path):
    """``stream()`` ingests what is new in the message folder and returns the log path."""
    folder, log_path = str(tmp_path / "messages"), str(tmp_path / "log")

    class Stream:
        source = folder
        path = log_path

        def land(self, records, files=3):
            write_user_messages(t.messages(records).repartition(files), folder, "files")

        def run(self):
            query = run_ingest(
                spark,
                folder,
                log_path,
                str(tmp_path / "checkpoint"),
                kind="files",
                trigger={"availableNow": True},
                maxFilesPerTrigger=1,
            )
            query.awaitTermination()
            return query

        def log(self):
            return read_user_log(spark, log_path, "files")

    return Stream()


def test_stream_equals_batch(spark, sf_dir, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    query = stream.run()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    batch = classify_users(t.messages(users), ["seq"]).select(*log_schema("files").names)
    stored = stream.log().select(*log_schema("files").names)
    assert sorted(stored.collect(), key=str) == sorted(batch.collect(), key=str)


def test_restart_adds_nothing(spark, sf_dir, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    stream.run()
    before = stream.log().count()
    stream.run()
    assert stream.log().count() == before == users.count()


def test_repeated_messages_do_not_add_users(spark, sf_dir, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    stream.run()
    again = users.where("seq < 5").withColumn("phone", F.lit("new"))
    stream.land(again.withColumn("seq", F.col("seq") + 10**6), files=1)
    stream.run()
    assert stream.log().count() == users.count() + 5
    latest = latest_users(spark, stream.path, "files")
    assert latest.columns == list(USER_FIELDS)
    assert latest.count() == users.count()
    assert latest.where("phone = 'new'").count() == 5


def test_refused_messages_are_kept_with_their_text(spark, sf_dir, stream):
    stream.land(t.full_users(spark, sf_dir))
    bad = spark.createDataFrame([(bytearray(b"garbage"), 7), (None, 8)], message_schema("files"))
    write_user_messages(bad, stream.source, "files")
    stream.run()
    refused = sorted(read_refused(spark, stream.path, "files").collect())
    assert [tuple(r) for r in refused] == [
        (7, "garbage", "malformed message"),
        (8, None, "empty message"),
    ]


def test_latest_users_reads_only_what_is_asked(spark, sf_dir, stream, executed):
    stream.land(t.full_users(spark, sf_dir))
    stream.run()
    plan = executed(latest_users(spark, stream.path, "files", ["gender", "dob"]))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema.startswith("struct<seq:bigint,id:string,gender:string,dob:string,reason:string")
    assert "IsNull(reason)" in plan


def test_log_files_are_told_apart_by_time(spark, sf_dir, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    stream.run()
    today = date.today()
    log = stream.log()
    assert log.where(written_since(today)).count() == users.count()
    assert log.where(written_since(today + timedelta(days=3))).count() == 0


def test_ingest_does_not_shuffle(spark, sf_dir, tmp_path, stream):
    stream.land(t.full_users(spark, sf_dir))
    messages = read_user_stream(spark, stream.source, "files")
    classified = classify_users(messages, order_columns("files"))
    assert classified.isStreaming
    query = (
        classified.writeStream.format("memory")
        .queryName("ingested")
        .option("checkpointLocation", str(tmp_path / "memory"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "from_json" in plan and "Exchange" not in plan


def test_kafka_options():
    assert kafka_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "users_created",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert kafka_options("b", topic="other")["subscribe"] == "other"


def test_a_repeated_batch_is_there_once(spark, sf_dir, tmp_path, stream):
    """The last batch was written but not committed: it runs again and replaces itself."""
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    stream.run()
    last = max(int(f.name) for f in (tmp_path / "checkpoint" / "commits").iterdir() if f.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    stream.run()
    assert stream.log().count() == users.count()
    assert stream.log().select("batch").distinct().count() == 3


def test_another_checkpoint_writes_over_nothing(spark, sf_dir, tmp_path, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users, files=1)
    for checkpoint in ("one", "two"):
        run_ingest(
            spark, stream.source, stream.path, str(tmp_path / checkpoint), "files", trigger={"availableNow": True}
        ).awaitTermination()
    assert stream.log().count() == 2 * users.count()
    assert latest_users(spark, stream.path, "files").count() == users.count()


def test_days_are_pruned(spark, sf_dir, stream, executed):
    stream.land(t.full_users(spark, sf_dir))
    stream.run()
    plan = executed(stream.log().where(written_since(date.today())))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_progress(spark, sf_dir, tmp_path, stream):
    users = t.full_users(spark, sf_dir)
    stream.land(users)
    bad = spark.createDataFrame([(bytearray(b"garbage"), 7), (None, 8)], message_schema("files"))
    write_user_messages(bad.coalesce(1), stream.source, "files")
    progress = IngestProgress()
    spark.streams.addListener(progress)
    try:
        progress.wait(stream.run())
        stream_again = stream.run()
        progress.wait(stream_again)
    finally:
        spark.streams.removeListener(progress)
    rows = progress.frame(spark).collect()
    assert len(rows) == 4 and len({r.batch for r in rows}) == 4
    assert [sum(r[c] for r in rows) for c in ("read", "accepted", "refused", "lost")] == [
        users.count() + 2, users.count(), 2, 0,
    ]


def test_lost_offsets():
    start, end = '{"t": {"0": 5, "1": 10}}', '{"t": {"0": 9, "1": 12}}'
    assert lost_offsets(start, end, 6) == 0
    assert lost_offsets(start, end, 2) == 4
    assert lost_offsets(None, end, 2) == 0
    assert lost_offsets(start, '{"t": {"0": 9, "1": 12, "2": 7}}', 2) == 0
    assert lost_offsets('{"logOffset": 1}', '{"logOffset": 2}', 7) == 0
