"""Columns a distribution is taken over."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import address_part, age_on, bin_labels, parse_dob
from rollcall.schema import AGE_EDGES, AGE_LABELS


def with_age(users: DataFrame, as_of: date | str, strict: bool = False) -> DataFrame:
    """Add ``age``: whole years between the birth date in ``dob`` and ``as_of``."""
    born = users.withColumn("_born", parse_dob(F.col("dob"), strict))
    return born.withColumn("age", age_on(F.col("_born"), as_of)).drop("_born")


def with_bins(
    df: DataFrame,
    column: str,
    out: str,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
) -> DataFrame:
    """Add ``out``: the label of the right-closed bin ``column`` falls in, NULL outside."""
    return df.withColumn(out, bin_labels(F.col(column), edges, labels))


def with_address_part(
    users: DataFrame, position: int, out: str, strict: bool = False
) -> DataFrame:
    """Add ``out``: the stripped address part at ``position`` from the end (-1 = country).

    Position -2, which the "city" dimension uses, is the state; -3 is the city proper.
    """
    return users.withColumn(out, address_part(F.col("address"), position, strict))


def _complaints() -> dict[str, Column]:
    """Reason -> whether a user has it; at most one each of birth date and address."""
    dob, address = F.col("dob"), F.col("address")
    return {
        "no dob": dob.isNull(),
        "dob is not a date": dob.isNotNull() & parse_dob(dob).isNull(),
        "no address": address.isNull(),
        "address has no comma": address.isNotNull() & ~address.contains(","),
    }


def rejected_for_analysis(users: DataFrame) -> DataFrame:
    """Users that drop out of a distribution because of bad data: ``id`` and ``reason``.

    These rows would fail the job in strict mode. An age outside all bins or a NULL gender is
    not bad data.
    """
    reasons = [F.when(bad, reason) for reason, bad in _complaints().items()]
    return users.select("id", F.concat_ws("; ", *reasons).alias("reason")).where("reason != ''")


def watch_rejects(users: DataFrame) -> tuple[DataFrame, Observation]:
    """``users``, and an observation of how many have which reason to be rejected.

    The counts are taken as the rows pass by on their way into something else, so they cost no
    scan. Once that is done ``reject_counts`` has them. A user may count under two reasons.
    """
    seen = Observation()
    counts = [F.count_if(bad).alias(reason) for reason, bad in _complaints().items()]
    return users.observe(seen, *counts), seen


def reject_counts(spark: SparkSession, seen: Observation) -> DataFrame:
    """``(reason, n)`` of an observation of ``watch_rejects``; reasons that nobody has with 0."""
    return spark.createDataFrame(list(seen.get.items()), "reason string, n bigint")
