"""Stored counts of a day, the base of the next day's."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_of_text
from rollcall.handover import handed_over
from rollcall.operators.counts import added_counts, count_changes
from rollcall.operators.keyed import latest_by_key, upsert_by_key
from rollcall.schema import BORN, COUNT_SCHEMA, DIMENSIONS, RESULT_PARTITIONS, order_columns, snapshot_schema
from rollcall.sources.log import read_user_log
from rollcall.sources.partitions import replace_partitions
from rollcall.sources.users import Snapshot, users_by_id

_COUNTED = (BORN, *[d for d in DIMENSIONS if d != "age"])


def write_user_counts(counts: DataFrame, path: str, as_of: date | str) -> None:
    """Store ``user_counts`` of a day in place of what is stored for it."""
    day = as_of_text(as_of)
    dated = counts.withColumn("analysis_date", F.lit(day)).select(*COUNT_SCHEMA.names)
    replace_partitions(dated, path, RESULT_PARTITIONS, [(d, day) for d in _COUNTED])


def read_user_counts(spark: SparkSession, path: str, as_of: date | str) -> DataFrame:
    """``(dimension, category, n)`` of a day, none if it has not been stored; reads that day only."""
    empty = spark.createDataFrame([], COUNT_SCHEMA)
    empty.write.mode("ignore").partitionBy(*RESULT_PARTITIONS).parquet(path)
    rows = spark.read.schema(COUNT_SCHEMA).parquet(path)
    return rows.where(F.col("analysis_date") == as_of_text(as_of)).select("dimension", "category", "n")


def counts_from_changes(
    spark: SparkSession,
    log_path: str,
    previous: Snapshot,
    counts: DataFrame,
    since: Column,
    kind: str = "kafka",
) -> DataFrame:
    """The counts after the log rows ``since``, from those that belong to the ``previous`` snapshot.

    Only users that have such rows are looked at: their new rows from the log, their old ones
    from their buckets of the snapshot (``users_by_id``). ``since`` may be too generous, as in
    ``compact_users``: a row that the snapshot holds already changes nothing.
    """
    order, names = order_columns(kind), snapshot_schema(kind).names
    log = read_user_log(spark, log_path, kind).where("reason is null").where(since)
    new = handed_over(latest_by_key(log.select(*names), ["id"], order), "changed-users")
    old = handed_over(users_by_id(spark, previous, new, kind).select(*names), "users-before")
    now = upsert_by_key(old, new, ["id"], order)
    return added_counts(counts, count_changes(old, now))

