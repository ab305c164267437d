"""The daily job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_of_text
from rollcall.operators import (
    chart_series,
    daily_distributions,
    distributions_of_counts,
    rejected_for_analysis,
    user_counts,
    watch_rejects,
)
from rollcall.schema import DATABASE
from rollcall.sources import (
    Snapshot,
    compact_users,
    counts_from_changes,
    ensure_tables,
    publish_results,
    publish_version,
    read_result_days,
    read_user_counts,
    write_chart_series,
    write_results,
    write_user_counts,
    written_since,
)


@dataclass(frozen=True)
class DailyPaths:
    """Folders of the daily job, all on storage that every executor reaches."""

    log: str
    snapshots: str
    results: str
    charts: str
    rejected: str
    database: str = DATABASE
    database_location: str | None = None
    #: Counts kept from day to day; without it every day is counted from all users.
    counts: str | None = None

    def snapshot(self, as_of: date | str) -> Snapshot:
        day = as_of_text(as_of)
        table = f"{self.database}.created_users_{day.replace('-', '')}"
        return Snapshot(f"{self.snapshots}/as_of={day}", table)


def run_daily(
    spark: SparkSession,
    paths: DailyPaths,
    as_of: date | str,
    kind: str = "kafka",
    mode: str = "replace",
    strict: bool = False,
    previous: date | str | None = None,
    since: Column | None = None,
    buckets: int | None = None,
    at_once: bool = False,
) -> DataFrame:
    """Tables, snapshot, distributions, rejected rows and charts of one day; returns its results.

    ``previous`` names the day whose snapshot this one builds on, and must not have been run
    before that day began; then only log folders written since are read. ``since`` is another
    condition to that end, ``buckets`` cuts the snapshot (see ``compact_users``). Running a day
    again replaces it, dimensions that have come out empty included.

    Where ``paths.counts`` is set, the day's counts are stored, and a day with a ``previous`` one
    corrects that day's counts by the users that have changed instead of counting all of them
    (but counts all where that day has none, and with ``strict``, which has to look at every user).
    ``at_once`` publishes the day as a whole (see ``publish_version``); the folder of results is
    then left alone.

    Reasons for rejection are counted by the scan that counts the users; the rows themselves are
    read again, to be stored, only on a day that has some.
    """
    day = as_of_text(as_of)
    ensure_tables(
        spark, paths.log, paths.results, paths.database, kind, paths.database_location
    )
    earlier = None
    if previous is not None:
        earlier = paths.snapshot(previous)
        since = written_since(previous) if since is None else since
    users = compact_users(spark, paths.log, paths.snapshot(day), kind, earlier, since, buckets)
    # Counted as the users pass by on their way into the distributions; no scan of its own.
    watched, seen = watch_rejects(users)
    results = daily_distributions(watched, day, strict)
    if paths.counts is not None:
        counts, before = user_counts(users if strict else watched), None
        if earlier is not None and not strict:
            before = read_user_counts(spark, paths.counts, previous)
        if before is not None and not before.isEmpty():
            counts, seen = counts_from_changes(spark, paths.log, earlier, before, since, kind), None
        write_user_counts(counts, paths.counts, day)
        if not strict:
            results = distributions_of_counts(read_user_counts(spark, paths.counts, day), day)
    if at_once:
        if mode != "replace":
            raise ValueError("a day that is published at once is replaced, not merged")
        stored = publish_version(spark, results, paths.results, day, paths.database)
    else:
        write_results(results, paths.results, mode, day)
        publish_results(spark, day, paths.database)
        stored = read_result_days(spark, paths.results).where(F.col("analysis_date") == day)
    _keep_rejects(spark, paths, day, users, seen)
    write_chart_series(chart_series(stored), paths.charts, day)
    return stored


def _keep_rejects(
    spark: SparkSession, paths: DailyPaths, day: str, users: DataFrame, seen: Observation | None
) -> None:
    """The rejected rows of a day; users are read again for them only if there are any."""
    rejected = rejected_for_analysis(users)
    if seen is not None and not any(seen.get.values()):
        rejected = spark.createDataFrame([], rejected.schema)
    rejected.write.mode("overwrite").parquet(f"{paths.rejected}/analysis_date={day}")
