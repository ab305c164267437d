"""Stored distributions: one dataset, partitioned by dimension and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_of_text
from rollcall.operators.keyed import latest_by_key
from rollcall.schema import DIMENSIONS, RESULT_KEY, RESULT_PARTITIONS, RESULT_SCHEMA
from rollcall.sources.partitions import replace_partitions


def ensure_results(spark: SparkSession, path: str) -> None:
    """Create an empty dataset at ``path`` if there is none; leave an existing one alone."""
    empty = spark.createDataFrame([], RESULT_SCHEMA)
    empty.write.mode("ignore").partitionBy(*RESULT_PARTITIONS).parquet(path)


def read_result_days(spark: SparkSession, path: str) -> DataFrame:
    """All stored results. The schema is given: left to itself Spark would make the day a DATE."""
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def read_results(
    spark: SparkSession, path: str, dimension: str, as_of: date | str
) -> DataFrame:
    """``(category, percentage)`` of one dimension on one day; reads that partition only."""
    day = as_of_text(as_of)
    return (
        read_result_days(spark, path)
        .where((F.col("dimension") == dimension) & (F.col("analysis_date") == day))
        .select("category", "percentage")
    )


def write_results(
    results: DataFrame, path: str, mode: str = "replace", as_of: date | str | None = None
) -> None:
    """Store distributions; writing the same ones again changes nothing.

    ``replace`` puts the new rows in place of the (dimension, day) partitions they belong to;
    given the day ``as_of``, a dimension that has no row on it any more is emptied, too.
    ``merge`` is an upsert by category into the day ``as_of``: categories that are not in
    ``results`` any more stay.
    """
    if mode == "merge":
        if as_of is None:
            raise ValueError("merge needs the day to merge into")
        results = _merged(results, path, as_of_text(as_of))
    elif mode != "replace":
        raise ValueError(f"mode is 'replace' or 'merge', not {mode!r}")
    expected = []
    if mode == "replace" and as_of is not None:
        expected = [(dimension, as_of_text(as_of)) for dimension in DIMENSIONS]
    replace_partitions(
        results.select(*RESULT_SCHEMA.names), path, RESULT_PARTITIONS, expected
    )


def _merged(results: DataFrame, path: str, day: str) -> DataFrame:
    spark = results.sparkSession
    ensure_results(spark, path)
    stored = read_result_days(spark, path).where(F.col("analysis_date") == day)
    old = stored.withColumn("_generation", F.lit(0))
    new = results.where(F.col("analysis_date") == day).withColumn("_generation", F.lit(1))
    both = old.unionByName(new)
    return latest_by_key(both, RESULT_KEY, ["_generation"])
