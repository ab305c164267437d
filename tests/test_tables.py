import pytest

from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import (
    classify_users,
    daily_distributions,
    gender_distribution,
    latest_by_key,
    upsert_by_key,
)
from rollcall.schema import DIMENSIONS, RESULT_SCHEMA, USER_FIELDS
from rollcall.sources import (
    Snapshot,
    append_user_log,
    compact_users,
    ensure_results,
    ensure_tables,
    latest_users,
    publish_results,
    read_result_days,
    read_results,
    read_snapshot,
    read_user_log,
    write_results,
)

DAY, NEXT = t.AS_OF, t.NEXT_DAY


def genders(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "gender string")


def rows(spark, path):
    return sorted(map(tuple, read_result_days(spark, path).collect()))


def test_rerun_changes_nothing(spark, sf_dir, tmp_path):
    path = str(tmp_path / "results")
    day = daily_distributions(t.users(spark, sf_dir), DAY)
    for _ in range(2):
        write_results(day, path)
        assert rows(spark, path) == sorted(map(tuple, day.collect()))


def test_replace_touches_its_own_partitions_only(spark, tmp_path):
    path = str(tmp_path / "results")
    write_results(gender_distribution(genders(spark, "f"), DAY), path)
    write_results(gender_distribution(genders(spark, "f", "m"), NEXT), path)
    write_results(gender_distribution(genders(spark, "m"), DAY), path)
    assert rows(spark, path) == [
        ("f", 50.0, "gender", NEXT),
        ("m", 50.0, "gender", NEXT),
        ("m", 100.0, "gender", DAY),
    ]


def test_merge_keeps_what_has_vanished(spark, tmp_path):
    path = str(tmp_path / "results")
    write_results(gender_distribution(genders(spark, "f", "m", "m", "x"), DAY), path, "merge", DAY)
    write_results(gender_distribution(genders(spark, "f"), NEXT), path, "merge", NEXT)
    write_results(gender_distribution(genders(spark, "f", "m"), DAY), path, "merge", DAY)
    assert rows(spark, path) == [
        ("f", 50.0, "gender", DAY),
        ("f", 100.0, "gender", NEXT),
        ("m", 50.0, "gender", DAY),
        ("x", 25.0, "gender", DAY),
    ]


def test_modes_are_checked(spark, tmp_path):
    day = gender_distribution(genders(spark, "f"), DAY)
    with pytest.raises(ValueError):
        write_results(day, str(tmp_path / "r"), "append")
    with pytest.raises(ValueError):
        write_results(day, str(tmp_path / "r"), "merge")


def test_one_partition_is_read_and_the_day_stays_text(spark, sf_dir, tmp_path, executed):
    path = str(tmp_path / "results")
    for day in (DAY, NEXT):
        write_results(daily_distributions(t.users(spark, sf_dir), day), path)
    found = read_results(spark, path, "gender", DAY)
    assert found.columns == ["category", "percentage"]
    assert found.count() == 2
    plan = executed(found)
    assert "PartitionFilters: [isnotnull(dimension" in plan
    assert f"(analysis_date#" in plan.split("PartitionFilters")[1]
    assert read_result_days(spark, path).schema["analysis_date"].dataType.simpleString() == "string"


def test_no_results_for_a_day_is_not_an_error(spark, tmp_path):
    path = str(tmp_path / "results")
    ensure_results(spark, path)
    ensure_results(spark, path)
    assert read_results(spark, path, "age", DAY).collect() == []
    assert read_result_days(spark, path).schema == RESULT_SCHEMA


def test_ensure_results_leaves_data_alone(spark, tmp_path):
    path = str(tmp_path / "results")
    write_results(gender_distribution(genders(spark, "f"), DAY), path)
    ensure_results(spark, path)
    assert rows(spark, path) == [("f", 100.0, "gender", DAY)]


def test_catalog(spark, sf_dir, tmp_path):
    log, results = str(tmp_path / "log"), str(tmp_path / "results")
    for _ in range(2):
        ensure_tables(spark, log, results, "people", "files", str(tmp_path / "db"))
    assert spark.sql("select * from people.created_users").columns == list(USER_FIELDS)
    assert spark.sql("select * from people.created_users").count() == 0
    users = t.full_users(spark, sf_dir)
    for step in (0, 1000):
        again = users.withColumn("seq", F.col("seq") + step)
        append_log(again, log, str(step))
    day = daily_distributions(users, DAY)
    write_results(day, results)
    for _ in range(2):
        publish_results(spark, DAY, "people")
    assert spark.sql("select * from people.created_users").count() == users.count()
    for dimension, category in DIMENSIONS.items():
        view = spark.sql(f"select * from people.{dimension}")
        assert view.columns == [category, "percentage", "analysis_date"]
        expected = day.where(f"dimension = '{dimension}'").drop("dimension")
        assert sorted(view.collect()) == sorted(expected.collect())
    spark.sql("drop database people cascade")


def snapshot(tmp_path, name, table=True):
    return Snapshot(str(tmp_path / name), f"snaps.{name}" if table else None)


def append_log(records, log, batch="0"):
    append_user_log(classify_users(t.messages(records), ["seq"]), log, batch, DAY, "files")


@pytest.mark.parametrize("table", [True, False])
def test_snapshot_upon_snapshot(spark, sf_dir, tmp_path, table):
    log = str(tmp_path / "log")
    spark.sql(f"create database snaps location '{tmp_path / 'db'}'")
    append_log(t.full_users(spark, sf_dir), log)
    first = snapshot(tmp_path, "first", table)
    compact_users(spark, log, first, "files")
    append_log(t.user_updates(spark, sf_dir), log, "1")
    newer = F.col("seq") >= 10**12
    second = snapshot(tmp_path, "second", table)
    for _ in range(2):
        found = compact_users(spark, log, second, "files", first, newer)
        whole = latest_users(spark, log, "files", ["id", "last_name", "seq"])
        assert sorted(found.select(*whole.columns).collect()) == sorted(whole.collect())
    spark.sql("drop database snaps cascade")


def test_a_catalog_that_forgets(spark, sf_dir, tmp_path):
    """A new session without a lasting catalog finds the folders, and writes over them again."""
    log = str(tmp_path / "log")
    first, second = snapshot(tmp_path, "first"), snapshot(tmp_path, "second")
    append_log(t.full_users(spark, sf_dir), log)
    for _ in range(2):
        spark.sql(f"create database snaps location '{tmp_path / 'db'}'")
        compact_users(spark, log, first, "files")
        spark.sql("drop database snaps cascade")
        spark.sql(f"create database snaps location '{tmp_path / 'db'}'")
        found = compact_users(spark, log, second, "files", first, F.col("seq") >= 100)
        assert found.count() == found.select("id").distinct().count() == 150
        spark.sql("drop database snaps cascade")


def test_merging_into_a_bucketed_snapshot_moves_the_news_only(
    spark, sf_dir, tmp_path, executed
):
    log = str(tmp_path / "log")
    spark.sql(f"create database snaps location '{tmp_path / 'db'}'")
    append_log(t.user_updates(spark, sf_dir), log)
    old = compact_users(spark, log, snapshot(tmp_path, "first"), "files")
    new = latest_by_key(read_user_log(spark, log, "files").select(*old.columns), ["id"], ["seq"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(upsert_by_key(old, new, ["id"], ["seq"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1
    assert "Bucketed: true" in plan
    assert "Exchange" in plan.split("Window [")[1]
    spark.sql("drop database snaps cascade")


def test_upsert_keeps_the_later_row(spark):
    schema = "k string, o int, v string"
    old = spark.createDataFrame([("a", 2, "old"), ("b", 2, "old"), ("c", 2, "old")], schema)
    new = spark.createDataFrame([("a", 1, "new"), ("b", 2, "new"), ("d", 1, "new")], schema)
    found = {r.k: r.v for r in upsert_by_key(old, new, ["k"], ["o"]).collect()}
    assert found == {"a": "old", "b": "new", "c": "old", "d": "new"}


def test_snapshot_cannot_replace_its_own_source(spark, tmp_path):
    same = snapshot(tmp_path, "same")
    with pytest.raises(ValueError):
        compact_users(spark, str(tmp_path / "log"), same, "files", previous=same)


def test_snapshot_is_known_by_its_folder(spark, sf_dir, tmp_path):
    """Two pipelines use one table name: each reads its own folder, none takes the other's table."""
    spark.sql(f"create database if not exists twins location '{tmp_path}/db'")
    log, other = str(tmp_path / "log"), str(tmp_path / "other")
    users = t.full_users(spark, sf_dir)
    append_log(users, log)
    append_log(users.where("seq <= 11"), other)
    first = Snapshot(str(tmp_path / "a"), "twins.users")
    second = Snapshot(str(tmp_path / "b"), "twins.users")
    assert compact_users(spark, log, first, "files").count() == users.count()
    with pytest.raises(ValueError, match="another folder"):
        compact_users(spark, other, second, "files")
    small = compact_users(spark, other, Snapshot(second.path), "files").count()
    assert small == users.where("seq <= 11").count() < users.count()
    assert read_snapshot(spark, second, "files").count() == small
    assert read_snapshot(spark, first, "files").count() == users.count()
    spark.sql("drop database twins cascade")


def test_number_of_buckets_is_kept(spark, sf_dir, tmp_path):
    spark.sql(f"create database if not exists buckets location '{tmp_path}/db'")
    log = str(tmp_path / "log")
    append_log(t.full_users(spark, sf_dir), log)
    first, second, third = (Snapshot(str(tmp_path / n), f"buckets.{n}") for n in "abc")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    compact_users(spark, log, first, "files", buckets=3)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        compact_users(spark, log, second, "files", first)
        compact_users(spark, log, third, "files", second, buckets=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    kept = []
    for s in (first, second, third):
        rows = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {s.table}").collect()}
        kept.append(rows["Num Buckets"])
    assert kept == ["3", "3", "5"]
    spark.sql("drop database buckets cascade")
