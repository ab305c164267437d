"""Percentage distributions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import as_of_text, raw_address_part, sql_literal, strip
from rollcall.operators.dimensions import with_age, with_bins
from rollcall.schema import (
    AGE_EDGES,
    AGE_LABELS,
    CITY_PART,
    COUNTRY_PART,
    DIMENSIONS,
    RESULT_SCHEMA,
)


def shares(
    df: DataFrame,
    dimensions: Mapping[str, str],
    declared: Mapping[str, Sequence[str]] | None = None,
    clean: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """``(dimension, category, percentage)`` of every dimension, from one scan of ``df``.

    ``dimensions`` maps a dimension to its column. NULL is in neither numerator nor denominator.
    ``declared`` maps a dimension to all its categories, which come out as 0.0 where they have
    no rows (as NULL where the whole dimension has none); its column must hold nothing else.
    ``clean`` maps a dimension to a function that turns what is in the column into the category
    (never into NULL).

    Rows are turned long (one per dimension) inside the scan stage and counted there, so the
    shuffle carries one row per task and category whatever the skew. Cleaning and zero rows come
    after that count: strings are cleaned once per distinct value, not once per user. The totals
    are taken from the same shuffled counts (Spark reuses the exchange), not from a window,
    which would pull all categories of a dimension into one task.
    """
    columns = [F.col(column).alias(dimension) for dimension, column in dimensions.items()]
    counts = (
        df.select(*columns)
        .unpivot([], list(dimensions), "dimension", "category")
        .where("category is not null")
        .groupBy("dimension", "category")
        .agg(F.count("*").alias("n"))
    )
    # One row per dimension, as many as the caller listed: safe to broadcast at any scale.
    totals = counts.groupBy("dimension").agg(F.sum("n").alias("total"))
    if clean:
        counts = counts.withColumn("category", _cleaned(clean))
    if declared:
        counts = counts.unionByName(zero_rows(df, declared))
    if clean or declared:
        counts = counts.groupBy("dimension", "category").agg(F.sum("n").alias("n"))
    return percentages(counts, totals)


def percentages(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``(dimension, category, percentage)`` of ``counts(dimension, category, n)``.

    ``totals(dimension, total)`` has a row per dimension.
    """
    # Divide first: (n / total) * 100 and 100 * n / total differ in the last bit.
    percentage = F.try_divide("n", "total") * 100
    return counts.join(F.broadcast(totals), "dimension", "left").select(
        "dimension", "category", percentage.alias("percentage")
    )


def _cleaned(clean: Mapping[str, Callable[[Column], Column]]) -> Column:
    category = F.col("category")
    for dimension, function in clean.items():
        here = F.col("dimension") == dimension
        category = F.when(here, function(F.col("category"))).otherwise(category)
    return category


def zero_rows(df: DataFrame, declared: Mapping[str, Sequence[str]]) -> DataFrame:
    """A count of 0 for every declared category."""
    rows = ", ".join(
        f"({sql_literal(dimension)}, {sql_literal(label)}, 0L)"
        for dimension, labels in declared.items()
        for label in labels
    )
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS declared(dimension, category, n)")


def share(df: DataFrame, key: str, categories: Sequence[str] | None = None) -> DataFrame:
    """``(category, percentage)`` of one column; see ``shares``.

    With ``categories`` these and no others are counted and come out.
    """
    declared = None
    if categories:
        declared = {key: categories}
        df = df.select(F.when(F.col(key).isin(*categories), F.col(key)).alias(key))
    return shares(df, {key: key}, declared).drop("dimension")


def stamp(df: DataFrame, as_of: date | str) -> DataFrame:
    """Add ``analysis_date`` as text. One date for the whole job, never the wall clock."""
    return df.withColumn("analysis_date", F.lit(as_of_text(as_of)))


def _dated(df: DataFrame, dimensions: Mapping[str, str], as_of, **kwargs) -> DataFrame:
    return stamp(shares(df, dimensions, **kwargs), as_of).select(*RESULT_SCHEMA.names)


def age_distribution(
    users: DataFrame,
    as_of: date | str,
    strict: bool = False,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
) -> DataFrame:
    """Share of every age group; all groups are present, empty ones with 0.0."""
    binned = with_bins(with_age(users, as_of, strict), "age", "age_group", edges, labels)
    return _dated(binned, {"age": "age_group"}, as_of, declared={"age": labels})


def gender_distribution(users: DataFrame, as_of: date | str) -> DataFrame:
    """Share of every gender as written: '' and ' f' are categories of their own."""
    return _dated(users, {"gender": "gender"}, as_of)


def country_distribution(users: DataFrame, as_of: date | str, strict: bool = False) -> DataFrame:
    """Share of every country, the last address part."""
    part = raw_address_part(F.col("address"), COUNTRY_PART, strict)
    parts = users.select(part.alias("country"))
    return _dated(parts, {"country": "country"}, as_of, clean={"country": strip})


def city_distribution(
    users: DataFrame, as_of: date | str, strict: bool = False, position: int = CITY_PART
) -> DataFrame:
    """Share of every "city". By long habit that is address part -2, the state; use -3 for the
    city itself."""
    part = raw_address_part(F.col("address"), position, strict)
    parts = users.select(part.alias("city"))
    return _dated(parts, {"city": "city"}, as_of, clean={"city": strip})


def daily_distributions(
    users: DataFrame,
    as_of: date | str,
    strict: bool = False,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
) -> DataFrame:
    """All four distributions of one day from one scan of the users."""
    address = F.col("address")
    aged = with_age(users.select("gender", "address", "dob"), as_of, strict)
    raw = with_bins(aged, "age", "age_group", edges, labels).select(
        "age_group",
        "gender",
        raw_address_part(address, CITY_PART, strict).alias("city"),
        raw_address_part(address, COUNTRY_PART, strict).alias("country"),
    )
    clean = {"city": strip, "country": strip}
    return _dated(raw, DIMENSIONS, as_of, declared={"age": labels}, clean=clean)
