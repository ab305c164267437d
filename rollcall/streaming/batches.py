"""Names of micro-batches that stay the same when a batch is repeated."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def batch_name(spark: SparkSession, checkpoint: str, number: int) -> str:
    """``<id of the stream>-<number of the batch>``, the id as the checkpoint keeps it."""
    stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
    return f"{stream}-{number:09}"
