"""Every message has a place of its own, whatever the batch, the task and the clock."""

import json
import os

from rollcall.plans import run_produce
from rollcall.schema import message_schema
from rollcall.sources.messages import BATCH_ROOM
from tests.test_profiles import PROFILE


def land(folder, name, emails, at):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"results": [{**PROFILE, "email": e}]}) for e in emails]
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (at, at))


def published(spark, tmp_path):
    query = run_produce(
        spark, str(tmp_path / "landed"), str(tmp_path / "messages"), str(tmp_path / "c"), "files",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    rows = spark.read.schema(message_schema("files")).parquet(str(tmp_path / "messages")).collect()
    return [(json.loads(bytes(r.value))["email"], r.seq) for r in sorted(rows, key=lambda r: r.seq)]


def test_messages_come_in_the_order_of_landing(spark, tmp_path):
    """By landing time, then name, then line, over files that are read in many parts."""
    first = [f"b{i}" for i in range(400)]
    land(tmp_path / "landed", "z.json", first, 1000)
    land(tmp_path / "landed", "b.json", ["late-b1", "late-b2"], 2000)
    land(tmp_path / "landed", "a.json", ["late-a"], 2000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = published(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [e for e, _ in found] == [*first, "late-a", "late-b1", "late-b2"]
    assert [s for _, s in found] == list(range(403))
    land(tmp_path / "landed", "0.json", ["next"], 500)
    found = published(spark, tmp_path)
    assert found[-1][0] == "next" and found[-1][1] % BATCH_ROOM == 0 and found[-1][1] >= BATCH_ROOM


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    land(tmp_path / "landed", "1.json", ["a", "b"], 1000)
    before = published(spark, tmp_path)
    for name in ("0", ".0.crc"):
        (tmp_path / "c" / "commits" / name).unlink()
    assert published(spark, tmp_path) == before


def test_lines_that_are_not_published_leave_no_doubt(spark, tmp_path):
    land(tmp_path / "landed", "1.json", ["a"], 1000)
    with (tmp_path / "landed" / "1.json").open("a") as file:
        file.write('{"results":[]}\n\n' + json.dumps({"results": [{**PROFILE, "email": "c"}]}) + "\n")
    assert [e for e, _ in published(spark, tmp_path)] == ["a", "c"]
