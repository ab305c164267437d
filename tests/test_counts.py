"""Distributions out of kept counts, rejects counted on the way, days published as a whole."""

import pytest
from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import (
    added_counts,
    classify_users,
    count_changes,
    daily_distributions,
    distributions_of_counts,
    reject_counts,
    rejected_for_analysis,
    user_counts,
    watch_rejects,
)
from rollcall.plans import DailyPaths, run_daily
from rollcall.schema import DIMENSIONS
from rollcall.sources import (
    Snapshot,
    append_user_log,
    compact_users,
    counts_from_changes,
    ensure_tables,
    latest_users,
    publish_version,
    read_published,
    read_snapshot,
    write_user_counts,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def append(records, log, batch, day=t.AS_OF):
    append_user_log(classify_users(t.messages(records), ["seq"]), log, batch, day, "files")


@pytest.mark.parametrize("day", [t.AS_OF, "2100-06-30", "1931-01-01"])
def test_counts_give_the_same_bits(spark, sf_dir, day):
    users = t.users(spark, sf_dir)
    assert rows(distributions_of_counts(user_counts(users), day)) == rows(daily_distributions(users, day))


def test_odd_users_count_alike(spark, sf_dir):
    users = t.event_profiles(spark, sf_dir).withColumn("gender", F.when(F.length("id") > 9, F.lit(" f")))
    assert rows(distributions_of_counts(user_counts(users), t.AS_OF)) == rows(daily_distributions(users, t.AS_OF))
    none = users.limit(0)
    assert rows(distributions_of_counts(user_counts(none), t.AS_OF)) == rows(daily_distributions(none, t.AS_OF))


def test_changes_take_categories_away(spark):
    schema = "id string, gender string, address string, dob string"
    old = spark.createDataFrame([("1", "f", "a, b, c, d", None), ("2", "m", "x, y", "1990-01-01T00:00:00.0Z")], schema)
    new = spark.createDataFrame([("1", "m", "a, b, c, e", None), ("2", "m", None, "bad"), ("3", None, None, None)], schema)
    changes = count_changes(old, new)
    assert ("gender", "f", -1) in rows(changes) and ("gender", "m", 1) in rows(changes)
    assert rows(added_counts(user_counts(old), changes)) == rows(user_counts(new))


@pytest.fixture
def base(spark, tmp_path):
    spark.sql(f"create database counted location '{tmp_path / 'db'}'")
    yield tmp_path
    spark.sql("drop database counted cascade")


def test_few_changes_open_few_buckets(spark, sf_dir, base):
    log, snapshot = str(base / "log"), Snapshot(str(base / "s"), "counted.s")
    append(t.full_users(spark, sf_dir), log, "0", "2024-06-01")
    compact_users(spark, log, snapshot, "files", buckets=16)
    counts = user_counts(read_snapshot(spark, snapshot, "files"))
    write_user_counts(counts, str(base / "counts"), t.AS_OF)
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    one = t.user_updates(spark, sf_dir).orderBy(F.desc("seq")).limit(1)
    append(one, log, "1", t.AS_OF)
    want = rows(user_counts(latest_users(spark, log, "files")))
    stored = read_snapshot(spark, snapshot, "files").select("id", "_metadata.file_name")
    touched = stored.where(F.col("id") == one.first().id).first().file_name
    for file in (base / "s").glob("*.parquet"):
        if file.name != touched:
            file.write_bytes(b"unreadable")
            (base / "s" / f".{file.name}.crc").unlink()
    since = F.col("ingest_date") >= F.lit(t.AS_OF).cast("date")
    assert rows(counts_from_changes(spark, log, snapshot, counts, since, "files")) == want


def test_days_from_changes(spark, sf_dir, tmp_path):
    names = ("log", "snapshots", "results", "charts", "rejected", "counts")
    paths = DailyPaths(**{n: str(tmp_path / n) for n in names}, database="deltas", database_location=str(tmp_path / "db"))
    updates = t.user_updates(spark, sf_dir)
    days = ["2024-06-28", "2024-06-29", "2024-06-30"]
    for n, day in enumerate(days):
        append(t.full_users(spark, sf_dir) if not n else updates.where(F.col("seq") % 2 == n - 1), paths.log, str(n), day)
        previous = days[n - 1] if n else None
        for _ in range(2):
            found = rows(run_daily(spark, paths, day, "files", previous=previous))
            latest = latest_users(spark, paths.log, "files")
            assert found == rows(daily_distributions(latest, day))
    strict = run_daily(spark, paths, days[2], "files", previous=days[1], strict=True)
    assert rows(strict) == found
    spark.sql("drop database deltas cascade")


def test_rejects_are_counted_by_the_scan_that_counts(spark, sf_dir, tmp_path):
    path = str(tmp_path / "users")
    t.event_profiles(spark, sf_dir).withColumn("gender", F.lit("f")).write.parquet(path)
    users = spark.read.parquet(path)
    watched, seen = watch_rejects(users)
    day = daily_distributions(watched, t.AS_OF)
    day.collect()
    plan = day._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    want = rejected_for_analysis(users).select(F.explode(F.split("reason", "; ")).alias("reason"))
    assert rows(reject_counts(spark, seen)) == rows(want.groupBy("reason").count())
    assert rows(day) == rows(daily_distributions(users, t.AS_OF))


def test_a_failed_day_leaves_the_old_one(spark, sf_dir, base):
    path = str(base / "results")
    ensure_tables(spark, str(base / "log"), path, "counted", "files")
    users = t.users(spark, sf_dir)
    first = daily_distributions(users, t.AS_OF)
    publish_version(spark, first, path, t.AS_OF, "counted")
    bad = users.withColumn("dob", F.when(F.col("gender") == "male", F.col("dob")))
    with pytest.raises(Exception, match="not a birth date"):
        publish_version(spark, daily_distributions(bad, t.AS_OF, strict=True), path, t.AS_OF, "counted")
    assert rows(read_published(spark, t.AS_OF, "counted")) == rows(first)
    shown = {d: rows(spark.table(f"counted.{d}").drop("analysis_date")) for d in DIMENSIONS}
    assert shown == {d: rows(first.where(f"dimension = '{d}'").select("category", "percentage")) for d in DIMENSIONS}
    second = daily_distributions(users.withColumn("gender", F.lit(None).cast("string")), t.AS_OF)
    for _ in range(2):
        assert rows(publish_version(spark, second, path, t.AS_OF, "counted")) == rows(second)
    assert spark.table("counted.gender").count() == 0


def test_run_daily_at_once(spark, sf_dir, tmp_path):
    names = ("log", "snapshots", "results", "charts", "rejected")
    paths = DailyPaths(**{n: str(tmp_path / n) for n in names}, database="whole", database_location=str(tmp_path / "db"))
    append(t.full_users(spark, sf_dir), paths.log, "0")
    found = run_daily(spark, paths, t.AS_OF, "files", at_once=True)
    assert rows(found) == rows(daily_distributions(t.full_users(spark, sf_dir), t.AS_OF))
    with pytest.raises(ValueError):
        run_daily(spark, paths, t.AS_OF, "files", mode="merge", at_once=True)
    spark.sql("drop database whole cascade")
