"""The keyed table kept current by change sets, and lookups by id."""

import pytest
from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import classify_users
from rollcall.schema import USER_FIELDS
from rollcall.sources import (
    Snapshot,
    add_changes,
    append_user_log,
    compact_users,
    current_users,
    ensure_changes,
    fold_changes,
    latest_users,
    publish_current_users,
    read_snapshot,
    users_by_id,
)
from rollcall.sources.paths import qualified


@pytest.fixture
def base(spark, tmp_path):
    spark.sql(f"create database keyed location '{tmp_path / 'db'}'")
    yield tmp_path
    spark.sql("drop database keyed cascade")


def arrive(spark, base, records, batch, day=t.AS_OF):
    log = str(base / "log")
    append_user_log(classify_users(t.messages(records), ["seq"]), log, batch, day, "files")
    add_changes(spark, log, batch, "keyed.changes", "files")
    return log


def rows(df):
    return sorted(map(str, df.select(*USER_FIELDS).collect()))


def test_current_after_every_batch(spark, sf_dir, base, executed):
    ensure_changes(spark, "keyed.changes", 4, "files")
    updates = t.user_updates(spark, sf_dir)
    snapshots = [None, Snapshot(str(base / "s1"), "keyed.s1"), Snapshot(str(base / "s2"), "keyed.s2")]
    now = None
    for step in range(4):
        records = t.full_users(spark, sf_dir) if step == 0 else updates.where(F.col("seq") % 3 == step - 1)
        log = arrive(spark, base, records, str(step))
        arrive(spark, base, records, str(step))  # repeated
        publish_current_users(spark, "keyed.changes", "keyed", now, "files")
        assert rows(current_users(spark, "keyed.changes", now, "files")) == rows(latest_users(spark, log, "files"))
        assert rows(spark.table("keyed.created_users")) == rows(latest_users(spark, log, "files"))
        if step in (1, 2):
            folded = fold_changes(spark, "keyed.changes", snapshots[step], now, "files")
            now = snapshots[step]
            assert rows(folded) == rows(latest_users(spark, log, "files"))
            assert spark.sql("show partitions keyed.changes").count() == 0
    settings = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(settings)
    spark.conf.set(settings, "-1")
    try:
        plan = executed(current_users(spark, "keyed.changes", now, "files"))
        view = executed(spark.table("keyed.created_users"))
    finally:
        spark.conf.set(settings, before)
    for p in (plan, view):
        assert "Exchange" not in p and p.count("Bucketed: true") == 2


def test_no_snapshot_replaces_itself(spark, base):
    ensure_changes(spark, "keyed.changes", 2, "files")
    same = Snapshot(str(base / "s"), "keyed.s")
    with pytest.raises(ValueError):
        fold_changes(spark, "keyed.changes", same, same, "files")


def snapshot_of(spark, sf_dir, base, buckets=8):
    log = str(base / "log")
    append_user_log(classify_users(t.messages(t.full_users(spark, sf_dir)), ["seq"]), log, "0", t.AS_OF, "files")
    snapshot = Snapshot(str(base / "snap"), "keyed.snap")
    compact_users(spark, log, snapshot, "files", buckets=buckets)
    return snapshot


def test_lookups_open_one_bucket(spark, sf_dir, base, executed):
    snapshot = snapshot_of(spark, sf_dir, base)
    wanted = f"00000000-0000-4000-8000-{'7':>012}"
    found = users_by_id(spark, snapshot, [wanted.upper()], "files")
    assert [r.id for r in found.collect()] == [wanted]
    # The plan names the buckets only of a scan that keeps them apart; they are left out either way.
    automatic = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(automatic, "false")
    try:
        assert "SelectedBucketsCount: 1 out of 8" in executed(users_by_id(spark, snapshot, [wanted], "files"))
    finally:
        spark.conf.unset(automatic)
    bucket = users_by_id(spark, snapshot, [wanted], "files").select("_metadata.file_name").first()[0]
    for file in (base / "snap").glob("*.parquet"):
        if file.name != bucket:
            file.write_bytes(b"unreadable")
            (base / "snap" / f".{file.name}.crc").unlink()
    assert users_by_id(spark, snapshot, [wanted], "files").count() == 1
    with pytest.raises(Exception):
        read_snapshot(spark, snapshot, "files").agg(F.max("phone")).collect()


def test_lookups_by_frame(spark, sf_dir, base, monkeypatch):
    snapshot = snapshot_of(spark, sf_dir, base)
    users = read_snapshot(spark, snapshot, "files")
    ids = users.where("seq % 2 = 0").select("id").union(spark.createDataFrame([("none",), (None,)], "id string"))
    want = sorted(r.id for r in users.where("seq % 2 = 0").collect())
    assert sorted(r.id for r in users_by_id(spark, snapshot, ids, "files").collect()) == want
    monkeypatch.setattr("rollcall.sources.users.MOST_LOOKED_UP", 10)
    assert sorted(r.id for r in users_by_id(spark, snapshot, ids, "files").collect()) == want
    assert users_by_id(spark, snapshot, [], "files").count() == 0


def test_row_groups_without_the_id_are_skipped(spark, sf_dir, base):
    """Within a file that is opened the Bloom filter decides: no row is read for an absent id."""
    snapshot = Snapshot(str(base / "plain"))
    log = str(base / "log")
    append_user_log(classify_users(t.messages(t.full_users(spark, sf_dir)), ["seq"]), log, "0", t.AS_OF, "files")
    compact_users(spark, log, snapshot, "files")
    absent = f"00000000-0000-4000-8000-{'7':>012}"[:-1] + "x"  # between the ids that are there
    for ids, least in (([absent], 0), ([absent[:-1] + "7"], 1)):
        found = users_by_id(spark, snapshot, ids, "files")
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        leaf = plan.collectLeaves().head()
        read = leaf.metrics().apply("numOutputRows").value()
        assert (read > 0) == bool(least)


def test_paths_have_one_spelling(spark, sf_dir, base):
    """A snapshot written under one spelling is found, merged into and replaced under others."""
    log = str(base / "log")
    append_user_log(classify_users(t.messages(t.full_users(spark, sf_dir)), ["seq"]), log, "0", t.AS_OF, "files")
    spellings = [str(base / "a"), f"file:{base}/a", f"file://{base}//a/", f"{base}//./a"]
    assert len({qualified(spark, s) for s in spellings[:3]}) == 1
    for spelling in spellings[:3]:
        compact_users(spark, log, Snapshot(spelling, "keyed.a"), "files", buckets=3)
    append_user_log(classify_users(t.messages(t.user_updates(spark, sf_dir)), ["seq"]), log, "1", t.AS_OF, "files")
    for spelling in spellings[:3]:
        previous = Snapshot(spelling, "keyed.a")
        assert "Bucketed: true" in read_snapshot(spark, previous, "files").groupBy("id").count()._jdf.queryExecution().toString()
        merged = compact_users(spark, log, Snapshot(f"{base}/b", "keyed.b"), "files", previous)
        assert rows(merged) == rows(latest_users(spark, log, "files"))
