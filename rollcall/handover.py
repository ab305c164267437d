"""Tables that a step hands over to the next one, on storage that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rollcall-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def handed_over(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written and read again: lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
