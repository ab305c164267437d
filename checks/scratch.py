"""Where a check that needs files may write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor must reach.

    Only a local session without that setting falls back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/rollcall-{uuid.uuid4()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="rollcall-")
