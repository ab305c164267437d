"""The append log: one folder per day of ingestion and batch."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_of_date, as_of_text
from rollcall.schema import LOG_PARTITIONS, log_schema, order_columns, stored_log_schema


def read_user_log(spark: SparkSession, path: str, kind: str = "kafka") -> DataFrame:
    """Everything ever ingested, refused messages included, with its day and batch."""
    return spark.read.schema(stored_log_schema(kind)).parquet(path)


def read_refused(spark: SparkSession, path: str, kind: str = "kafka") -> DataFrame:
    """Messages that did not become users: order columns, text and reason."""
    log = read_user_log(spark, path, kind).where("reason is not null")
    return log.select(*order_columns(kind), "raw", "reason")


def write_log_batch(classified: DataFrame, path: str, batch: str) -> None:
    """Put ``classified`` messages, which have an ``ingest_date``, into the log as one batch.

    The batch is a folder of its own, so writing it again replaces it: a batch that a stream
    repeats after a failure is there once. Nothing is shuffled.
    """
    named = classified.withColumn("batch", F.lit(batch))
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOG_PARTITIONS)
        .parquet(path)
    )


def append_user_log(
    classified: DataFrame, path: str, batch: str, day: date | str, kind: str = "kafka"
) -> None:
    """Put one batch of classified messages into the log without a stream: a backfill, say."""
    stamped = classified.select(*log_schema(kind).names).withColumn(
        "ingest_date", F.lit(as_of_text(day)).cast("date")
    )
    write_log_batch(stamped, path, batch)


def written_since(day: date | str) -> Column:
    """Condition on the log for ``compact_users``: ingested on that day, the one before or later.

    Days are folders, so earlier ones are not opened. It is the day of ingestion that counts, so
    messages that arrive late or out of order are not missed. The day of slack covers batches
    that were being written while the earlier snapshot was made.
    """
    first = as_of_date(day) - timedelta(days=1)
    return F.col("ingest_date") >= F.lit(first.isoformat()).cast("date")
