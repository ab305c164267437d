"""Counts behind the distributions, kept from day to day and corrected by what has changed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import age_on, bin_labels, parse_dob, raw_address_part, strip
from rollcall.operators.distribution import percentages, stamp, zero_rows
from rollcall.schema import (
    AGE_EDGES,
    AGE_LABELS,
    BORN,
    CITY_PART,
    COUNTRY_PART,
    DIMENSIONS,
    RESULT_SCHEMA,
)


def user_counts(users: DataFrame) -> DataFrame:
    """``(dimension, category, n)`` of every gender, city and country, and of every birth date.

    Ages change by themselves from day to day, birth dates do not: the dimension ``born`` holds a row
    per birth date (there are some ten thousands), of which any day's age groups can be made.
    NULL and what cannot be read is left out, as in ``daily_distributions``. One scan, and counts
    before the shuffle.
    """
    address = F.col("address")
    raw = users.select(
        parse_dob(F.col("dob")).cast("string").alias(BORN),
        "gender",
        raw_address_part(address, CITY_PART).alias("city"),
        raw_address_part(address, COUNTRY_PART).alias("country"),
    )
    counts = (
        raw.unpivot([], raw.columns, "dimension", "category")
        .where("category is not null")
        .groupBy("dimension", "category")
        .agg(F.count("*").alias("n"))
    )
    parts = F.col("dimension").isin("city", "country")
    clean = F.when(parts, strip(F.col("category"))).otherwise(F.col("category"))
    return counts.groupBy("dimension", clean.alias("category")).agg(F.sum("n").alias("n"))


def count_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What ``user_counts`` gains where the users ``old`` have become ``new``: not 0, may be below."""
    lost = user_counts(old).withColumn("n", -F.col("n"))
    return added_counts(lost, user_counts(new))


def added_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts with changes added; categories that nobody has any more are gone."""
    both = counts.unionByName(changes)
    total = both.groupBy("dimension", "category").agg(F.sum("n").alias("n"))
    return total.where("n <> 0")


def distributions_of_counts(
    counts: DataFrame,
    as_of: date | str,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
) -> DataFrame:
    """The four distributions of a day, out of ``user_counts``; to the last bit those of the users."""
    age = age_on(F.col("category").cast("date"), as_of)
    group = bin_labels(age, edges, labels)
    born = F.col("dimension") == BORN
    dated = counts.select(
        F.when(born, F.lit("age")).otherwise(F.col("dimension")).alias("dimension"),
        F.when(born, group).otherwise(F.col("category")).alias("category"),
        "n",
    ).where("category is not null")
    totals = dated.groupBy("dimension").agg(F.sum("n").alias("total"))
    every = dated.unionByName(zero_rows(counts, {"age": labels}))
    every = every.groupBy("dimension", "category").agg(F.sum("n").alias("n"))
    shares = percentages(every, totals)
    return stamp(shares, as_of).select(*RESULT_SCHEMA.names).where(F.col("dimension").isin(*DIMENSIONS))
