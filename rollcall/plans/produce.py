"""Landed API responses to user messages, as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators import classify_profiles, encode_users
from rollcall.schema import TOPIC
from rollcall.sources import read_responses
from rollcall.sources.profiles import LANDED
from rollcall.streaming import write_message_stream


def run_produce(
    spark: SparkSession,
    landed: str,
    target: str,
    checkpoint: str,
    kind: str = "kafka",
    topic: str = TOPIC,
    id_from: Sequence[str] | None = None,
    whole_files: bool = False,
    trigger: dict[str, Any] | None = None,
    strict: bool = False,
    first_batch: int = 0,
) -> StreamingQuery:
    """Publish every response that lands in the folder ``landed``, until stopped.

    A topic may get a message twice when a batch is repeated after a failure. With random ids
    that is a second user; name profile paths in ``id_from`` to make it the same one. Responses
    without a profile and profiles that lack a path are not published: ``strict`` fails the
    stream at the first one, and ``run_rejects`` keeps the others with their text.

    Of two responses with one id the one that landed later is the later message, also within a
    batch and a file; ``first_batch`` is that of ``write_message_stream``.
    """
    origin = () if kind == "kafka" else LANDED
    classified = _classified(spark, landed, whole_files, id_from, strict, origin)
    users = encode_users(classified.where("reason is null"), origin)
    return write_message_stream(users, target, checkpoint, kind, topic, trigger, first_batch)


def run_rejects(
    spark: SparkSession,
    landed: str,
    rejected: str,
    checkpoint: str,
    id_from: Sequence[str] | None = None,
    whole_files: bool = False,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Keep ``(raw, reason)`` of every response that ``run_produce`` does not publish."""
    classified = _classified(spark, landed, whole_files, id_from, False)
    writer = (
        classified.where("reason is not null")
        .select("raw", "reason")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", rejected)
        .option("checkpointLocation", checkpoint)
    )
    return (writer if trigger is None else writer.trigger(**trigger)).start()


def _classified(
    spark: SparkSession,
    landed: str,
    whole_files: bool,
    id_from: Sequence[str] | None,
    strict: bool,
    carry: Sequence[str] = (),
) -> DataFrame:
    responses = read_responses(spark, landed, whole_files, stream=True, landed=bool(carry))
    return classify_profiles(responses, id_from, strict, carry)
