"""Replacing partitions, those that came out empty included."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def replace_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], expected: Iterable[tuple] = ()
) -> None:
    """Put the rows of ``df`` in place of the partitions they belong to.

    Of the ``expected`` partitions (values in the order of ``partitions``) those without a row
    are emptied. Which ones have rows is observed while they are written, not asked again.
    """
    seen = Observation()
    values = F.collect_set(F.struct(*[F.col(c).cast("string") for c in partitions]))
    (
        df.observe(seen, values.alias("seen"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    written = {tuple(row) for row in seen.get["seen"]}
    empty = df.drop(*partitions).limit(0)
    for key in expected:
        if tuple(map(str, key)) not in written:
            folder = "/".join(f"{name}={value}" for name, value in zip(partitions, key))
            empty.write.mode("overwrite").parquet(f"{path}/{folder}")
