"""User messages to a topic, as a stream."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rollcall.schema import TOPIC
from rollcall.sources.messages import in_landing_order, kafka_target
from rollcall.streaming.batches import batch_name


def write_message_stream(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    kind: str = "kafka",
    topic: str = TOPIC,
    trigger: dict[str, Any] | None = None,
    first_batch: int = 0,
) -> StreamingQuery:
    """Publish a stream of encoded users; the streaming twin of ``write_user_messages``.

    A topic orders messages itself. For files ``messages`` have the columns ``LANDED``, and every
    message gets a sequence of its own (``in_landing_order``); a batch is a folder that a repeated
    batch replaces. A new checkpoint counts from 0 again: give ``first_batch`` beyond the last
    batch of the old one, or what it publishes comes before what is there.
    """
    if kind == "kafka":
        writer = (
            messages.select("value")
            .writeStream.format("kafka")
            .options(**kafka_target(target, topic))
            .outputMode("append")
        )
    else:

        def publish(rows: DataFrame, number: int) -> None:
            rows.persist()
            try:
                batch = batch_name(rows.sparkSession, checkpoint, number)
                ordered = in_landing_order(rows, first_batch + number)
                ordered.write.mode("overwrite").parquet(f"{target}/batch={batch}")
            finally:
                rows.unpersist()

        writer = messages.writeStream.foreachBatch(publish)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()
