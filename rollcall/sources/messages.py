"""Publishing user messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.schema import TOPIC, message_schema
from rollcall.sources.profiles import LANDED


def kafka_target(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Options of a topic to write to."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def with_order(messages: DataFrame) -> DataFrame:
    """Messages for files, which must bring the order column that a topic supplies by itself.

    Without a ``seq`` of their own they get the time of publishing, all the same one: two of one
    user then have no order. ``run_produce`` numbers them instead.
    """
    if "seq" not in messages.columns:
        messages = messages.withColumn("seq", F.unix_micros(F.current_timestamp()))
    return messages.select(*message_schema("files").names)


#: Messages that a batch may hold: its number fills the rest of a 63-bit sequence.
BATCH_ROOM = 1 << 36


def in_landing_order(messages: DataFrame, number: int) -> DataFrame:
    """Messages of one batch with ``seq``: first the batch, then the file, then the place in it.

    ``messages`` have the columns ``LANDED``. Files are in the order of landing, by name where they
    landed at once. Rows of one part of a file are read one after the other by one task, so that a
    running number tells their places; what lies before a part is summed up over the parts, one row
    each. The order does not depend on tasks, clocks or reruns.
    """
    marked = messages.withColumn("_row", F.monotonically_increasing_id())
    order = Window.orderBy(*LANDED).rowsBetween(Window.unboundedPreceding, -1)
    parts = marked.groupBy(*LANDED).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(order), F.lit(0))
    parts = parts.select(*LANDED, "_first", before.alias("_before"))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    seq = F.lit(number * BATCH_ROOM) + place
    return marked.join(parts, list(LANDED)).select("value", seq.alias("seq"))


def write_user_messages(
    messages: DataFrame, target: str, kind: str = "kafka", topic: str = TOPIC
) -> None:
    """Publish encoded users: to a topic of the brokers ``target``, or as files under it.

    Messages carry no key, so a topic spreads them over its partitions.
    """
    if kind == "kafka":
        options = kafka_target(target, topic)
        messages.select("value").write.format("kafka").options(**options).save()
    else:
        with_order(messages).write.mode("append").parquet(target)
