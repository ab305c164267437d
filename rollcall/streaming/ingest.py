"""Messages to the append log, as a stream."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.messages import classify_users
from rollcall.schema import TOPIC, log_schema, message_schema, order_columns
from rollcall.sources.changes import add_changes
from rollcall.sources.log import write_log_batch
from rollcall.streaming.batches import batch_name
from rollcall.streaming.progress import WATCHED


def kafka_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Read one topic from its beginning and carry on past offsets that are gone."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_user_stream(
    spark: SparkSession, source: str, kind: str = "kafka", **options: Any
) -> DataFrame:
    """Stream of ``(value, order columns)`` from the brokers, or the message folder, ``source``.

    Further options go to the source as they are: ``topic``, ``maxOffsetsPerTrigger`` and
    ``minPartitions`` for a topic, ``maxFilesPerTrigger`` for files.
    """
    reader = spark.readStream
    if kind == "kafka":
        topic = options.pop("topic", TOPIC)
        stream = (
            reader.format("kafka").options(**kafka_options(source, topic), **options).load()
        )
    else:
        stream = reader.schema(message_schema(kind)).options(**options).parquet(source)
    return stream.select("value", *order_columns(kind))


def write_user_log(
    classified: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    changes: str | None = None,
    kind: str = "kafka",
) -> StreamingQuery:
    """Append classified messages to the log and return the running query.

    Every micro-batch becomes a folder of the log, ``ingest_date=.../batch=<stream>-<number>``.
    Day and number are in the checkpoint, so a batch that is repeated after a failure takes the
    place of itself: every message is there once, also across restarts and lost executors. The
    stream's own id is in the name, too: another checkpoint never writes over this one's batches.

    Nothing is shuffled: each task writes what it read. Good and refused messages share the file,
    so the source is read and parsed once; ``reason`` tells them apart. ``changes`` names a table
    made by ``ensure_changes``, which then gets the batch's last row of every user.
    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``; without it micro-batches
    follow one another.
    """
    watched = classified.withColumn("ingest_date", F.current_date()).observe(
        WATCHED,
        F.count("*").alias("read"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("refused"),
    )

    def keep(rows: DataFrame, number: int) -> None:
        batch = batch_name(rows.sparkSession, checkpoint, number)
        write_log_batch(rows, path, batch)
        if changes is not None:
            add_changes(rows.sparkSession, path, batch, changes, kind)

    writer = watched.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_ingest(
    spark: SparkSession,
    source: str,
    log_path: str,
    checkpoint: str,
    kind: str = "kafka",
    trigger: dict[str, Any] | None = None,
    changes: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Source to log. Call ``awaitTermination()`` on the result to run until stopped."""
    messages = read_user_stream(spark, source, kind, **options)
    classified = classify_users(messages, order_columns(kind))
    return write_user_log(
        classified.select(*log_schema(kind).names), log_path, checkpoint, trigger, changes, kind
    )
