"""Chart-ready data out of stored results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import percent_label
from rollcall.operators.places import with_places
from rollcall.schema import CHART_UPRIGHT_ABOVE, CHART_Y_LABEL, CHARTS

_CHART = ["dimension", "analysis_date"]
_SALTS = 32


def chart_series(results: DataFrame) -> DataFrame:
    """One row per bar of every chart: text, position (``rank``) and layout.

    Equal percentages share a rank. Only dimensions with a chart come out. ``results`` is read
    twice, so give it stored results rather than distributions yet to be computed.

    Rank and category count come from the distinct percentages of a chart, not from its
    categories. A percentage is a whole count over a common total, and k different counts need
    at least k(k+1)/2 users, so the window over them stays small (under half a million
    rows for 10^11 users) even where the categories themselves run into millions.
    """
    bars = _with_levels(results.where(F.col("dimension").isin(*CHARTS)))
    upright = F.col("n_categories") > CHART_UPRIGHT_ABOVE
    return bars.select(
        "dimension",
        "analysis_date",
        (F.col("_above") + 1).alias("rank"),
        "category",
        "percentage",
        percent_label(F.col("percentage")).alias("label"),
        F.concat(_text(1), F.lit(" on "), F.col("analysis_date")).alias("title"),
        _text(0).alias("x_label"),
        F.lit(CHART_Y_LABEL).alias("y_label"),
        F.when(upright, 90).otherwise(0).alias("rotation"),
        F.when(upright, F.lit(0.3)).otherwise(F.lit(0.15)).alias("bottom_margin"),
        "n_categories",
        _text(2).alias("file_name"),
    )


def _text(index: int) -> Column:
    chain = None
    for dimension, texts in CHARTS.items():
        here = F.col("dimension") == dimension
        chain = (F if chain is None else chain).when(here, F.lit(texts[index]))
    return chain


def _with_levels(bars: DataFrame) -> DataFrame:
    """``bars`` with the bars above their own percentage (``_above``) and of the whole chart.

    A level, all bars of one percentage, may hold nearly all bars of a chart. Bars are dealt
    over ``_SALTS`` by their category, and every level is there once for each.
    """
    levels = bars.groupBy(*_CHART, "percentage").agg(F.count("*").alias("_bars"))
    chart = Window.partitionBy(*_CHART)
    downwards = chart.orderBy(F.desc_nulls_last("percentage")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    levels = levels.select(
        *[F.col(c).alias(f"_{c}") for c in (*_CHART, "percentage")],
        (F.sum("_bars").over(downwards) - F.col("_bars")).alias("_above"),
        F.sum("_bars").over(chart).alias("n_categories"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    levels = levels.select("*", every)
    same_level = [F.col(c) == F.col(f"_{c}") for c in _CHART]
    same_level.append(F.col("percentage").eqNullSafe(F.col("_percentage")))
    same_level.append(F.pmod(F.xxhash64("category"), F.lit(_SALTS)).cast("int") == F.col("_salt"))
    return bars.join(levels, same_level)


def chart_arrays(results: DataFrame, max_items: int = 100_000) -> DataFrame:
    """Two parallel lists per dimension and day: categories and percentages, largest first.

    Equal percentages are in order of category. A long chart comes in chunks of exactly
    ``max_items`` bars, the last one of what is left: the chunks in order are the whole chart, in
    one and the same order at every length, and nothing is left out. ``results`` are sorted and
    written once when this is called.
    """
    largest_first = [F.desc_nulls_last("percentage"), F.asc_nulls_first("category")]
    chunk = F.floor(F.col("_place") / F.lit(max_items)).cast("int")
    bar = F.struct("_place", "category", "percentage")
    lists = (
        with_places(results.select(*_CHART, "category", "percentage"), _CHART, largest_first, "_place")
        .groupBy(*_CHART, chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(bar)).alias("_bars"))
    )
    return lists.select(
        *_CHART,
        "chunk",
        F.col("_bars.category").alias("categories"),
        F.col("_bars.percentage").alias("percentages"),
    )
