"""Continuous publishing and ingestion of user messages."""

from rollcall.streaming.ingest import kafka_options, read_user_stream, run_ingest, write_user_log
from rollcall.streaming.progress import IngestProgress
from rollcall.streaming.publish import write_message_stream

__all__ = [
    "IngestProgress",
    "kafka_options",
    "read_user_stream",
    "run_ingest",
    "write_message_stream",
    "write_user_log",
]
