from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import classify_users, daily_distributions, encode_users
from rollcall.plans import DailyPaths, run_daily
from rollcall.schema import order_columns
from rollcall.sources import append_user_log, latest_users, read_chart_series, read_result_days, read_snapshot


@pytest.fixture
def paths(spark, tmp_path):
    names = ("log", "snapshots", "results", "charts", "rejected")
    folders = {name: str(tmp_path / name) for name in names}
    yield DailyPaths(**folders, database="daily", database_location=str(tmp_path / "db"))
    spark.sql("drop database if exists daily cascade")


def append(records, paths, batch="0", day=t.AS_OF):
    append_user_log(classify_users(t.messages(records), ["seq"]), paths.log, batch, day, "files")


@pytest.mark.parametrize("by_order", [True, False])
def test_day_by_day(spark, sf_dir, paths, by_order):
    customers = t.full_users(spark, sf_dir)
    append(customers, paths)
    first = run_daily(spark, paths, t.AS_OF, "files").collect()
    assert sorted(first) == sorted(daily_distributions(customers, t.AS_OF).collect())

    append(t.user_updates(spark, sf_dir), paths, "1", t.NEXT_DAY)
    since = F.col("seq") >= 10**12 if by_order else None
    second = run_daily(
        spark, paths, t.NEXT_DAY, "files", previous=t.AS_OF, since=since
    ).collect()
    latest = latest_users(spark, paths.log, "files")
    assert sorted(second) == sorted(daily_distributions(latest, t.NEXT_DAY).collect())
    snapshot = read_snapshot(spark, paths.snapshot(t.NEXT_DAY), "files")
    assert sorted(map(str, snapshot.select(*latest.columns).collect())) == sorted(
        map(str, latest.collect())
    )
    days = read_result_days(spark, paths.results).groupBy("analysis_date").count().collect()
    assert {r[0] for r in days} == {t.AS_OF, t.NEXT_DAY}
    charts = read_chart_series(spark, paths.charts)
    assert {tuple(r) for r in charts.select("analysis_date", "dimension").distinct().collect()} == {
        (day, dimension)
        for day in (t.AS_OF, t.NEXT_DAY)
        for dimension in ("age", "gender", "country")
    }


def test_files_before_the_snapshot_are_not_opened(spark, sf_dir, paths):
    append(t.full_users(spark, sf_dir), paths, "0", "2024-06-28")
    run_daily(spark, paths, t.AS_OF, "files")
    for part in Path(paths.log).glob("ingest_date=2024-06-28/*/*.parquet"):
        part.write_bytes(b"unreadable")
    for crc in Path(paths.log).glob("*/*/.*.crc"):
        crc.unlink()
    append(t.user_updates(spark, sf_dir).where("seq % 3 = 0"), paths, "1", t.NEXT_DAY)
    run_daily(spark, paths, t.NEXT_DAY, "files", previous=t.AS_OF)
    snapshot = read_snapshot(spark, paths.snapshot(t.NEXT_DAY), "files")
    assert snapshot.count() == 150
    assert snapshot.where("seq > 150").count() > 100


def test_a_repeated_day_changes_nothing(spark, sf_dir, paths):
    append(t.full_users(spark, sf_dir), paths)
    runs = [sorted(run_daily(spark, paths, t.AS_OF, "files").collect()) for _ in range(2)]
    assert runs[0] == runs[1]
    assert read_chart_series(spark, paths.charts).count() == len(
        [r for r in runs[0] if r.dimension != "city"]
    )


def test_rejected_rows_are_stored(spark, sf_dir, paths):
    users = t.full_users(spark, sf_dir)
    append(users.withColumn("dob", F.when(F.col("seq") >= 10, F.col("dob"))), paths)
    run_daily(spark, paths, t.AS_OF, "files")
    rejected = spark.read.parquet(f"{paths.rejected}/analysis_date={t.AS_OF}")
    assert [r.reason for r in rejected.collect()] == ["no dob"] * 10


def test_topic_order(spark, sf_dir, paths):
    """The same job on rows as a topic delivers them, ordered by time, partition and offset."""
    users = t.full_users(spark, sf_dir)

    def arrive(when, offset, phone):
        messages = encode_users(users.withColumn("phone", F.lit(phone)))
        stamped = messages.select(
            "value",
            F.lit(when).cast("timestamp").alias("timestamp"),
            F.lit(0).alias("partition"),
            F.lit(offset).cast("bigint").alias("offset"),
        )
        classified = classify_users(stamped, order_columns("kafka"))
        append_user_log(classified, paths.log, f"{when} {offset}", when[:10])

    arrive("2024-06-30 10:00:00", 7, "late")
    arrive("2024-06-30 10:00:00", 6, "early")
    run_daily(spark, paths, t.AS_OF)
    seen = spark.sql("select distinct phone from daily.created_users").collect()
    assert [r.phone for r in seen] == ["late"]
    arrive("2024-07-01 09:00:00", 1, "next day")
    since = F.col("timestamp") >= "2024-07-01"
    run_daily(spark, paths, t.NEXT_DAY, previous=t.AS_OF, since=since)
    snapshot = read_snapshot(spark, paths.snapshot(t.NEXT_DAY))
    assert snapshot.count() == users.count()
    assert snapshot.where("phone = 'next day'").count() == users.count()
    assert spark.sql("select distinct phone from daily.created_users").first().phone == "next day"
