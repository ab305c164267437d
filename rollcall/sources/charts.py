"""Chart data on disk, one folder per day and chart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from rollcall.functions import as_of_text
from rollcall.schema import CHARTS
from rollcall.sources.partitions import replace_partitions

_PARTITIONS = ("analysis_date", "dimension")

SERIES_SCHEMA = (
    "rank bigint, category string, percentage double, label string, title string, "
    "x_label string, y_label string, rotation int, bottom_margin double, n_categories bigint, "
    "file_name string, analysis_date string, dimension string"
)


def write_chart_series(
    series: DataFrame, path: str, as_of: date | str | None = None
) -> None:
    """Store chart series under ``path/analysis_date=.../dimension=...``, replacing those
    of the same day and chart. Given the day ``as_of``, a chart without bars is emptied, too."""
    expected = [] if as_of is None else [(as_of_text(as_of), chart) for chart in CHARTS]
    replace_partitions(series, path, _PARTITIONS, expected)


def read_chart_series(spark: SparkSession, path: str) -> DataFrame:
    """Stored chart series; the day stays text."""
    return spark.read.schema(SERIES_SCHEMA).parquet(path)
