"""Landed API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schema import RESPONSE_SCHEMA


#: Where a response was landed: files in the order of landing, and the parts they are read in.
LANDED = ("_landed_at", "_landed_in", "_part")


def read_responses(
    spark: SparkSession,
    path: str,
    whole_files: bool = False,
    stream: bool = False,
    landed: bool = False,
) -> DataFrame:
    """``(value, profile)`` of every landed response: its text, and its first profile or NULL.

    With ``landed`` also where it comes from, in the columns ``LANDED``.
    """
    reader = spark.readStream if stream else spark.read
    text = reader.text(path, wholetext=whole_files).where(F.trim("value") != "")
    profile = F.get(F.from_json("value", RESPONSE_SCHEMA)["results"], F.lit(0))
    places = ("file_modification_time", "file_path", "file_block_start")
    origin = [F.col(f"_metadata.{p}").alias(name) for p, name in zip(places, LANDED)] if landed else []
    return text.select("value", profile.alias("profile"), *origin)


def read_raw_profiles(
    spark: SparkSession,
    path: str,
    whole_files: bool = False,
    stream: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The first profile of every landed response, as a nested row.

    A response is a line of text, or a file with ``whole_files``. One without a profile fails
    the job if ``strict``; otherwise it is found in ``rejected_responses``.
    """
    responses = read_responses(spark, path, whole_files, stream)
    profile = F.col("profile")
    if strict:
        complaint = F.concat(F.lit("response without a profile: "), F.col("value"))
        # Read through the check, so that no optimisation can take it out.
        checked = F.when(profile.isNull(), F.raise_error(complaint).cast("boolean"))
        responses = responses.where(F.coalesce(checked, F.lit(True)))
    return responses.where(profile.isNotNull()).select("profile.*")


def rejected_responses(
    spark: SparkSession, path: str, whole_files: bool = False, stream: bool = False
) -> DataFrame:
    """Text of the responses that hold no profile."""
    return read_responses(spark, path, whole_files, stream).where("profile is null").select("value")
