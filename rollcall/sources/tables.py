"""Catalog entries over the datasets, for plain SQL users."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import as_of_text, sql_literal
from rollcall.schema import (
    DATABASE,
    DIMENSIONS,
    RESULT_PARTITIONS,
    RESULT_SCHEMA,
    USER_FIELDS,
    order_columns,
    stored_log_schema,
)
from rollcall.sources.partitions import replace_partitions
from rollcall.sources.paths import qualified
from rollcall.sources.results import ensure_results


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _location(path: str) -> str:
    return f"LOCATION {sql_literal(path)}"


def ensure_tables(
    spark: SparkSession,
    log_path: str,
    results_path: str,
    database: str = DATABASE,
    kind: str = "kafka",
    location: str | None = None,
) -> None:
    """Create what is missing of the database, its tables and the views on them.

    Tables: ``user_log`` and ``results``, over the folders the jobs write. Views:
    ``created_users``, the last row of every user in the log, and ``age``, ``gender``, ``city``,
    ``country``, the results of one dimension each under the column names of old,
    ``(<category>, percentage, analysis_date)``. What exists is left alone;
    a new table finds the days that are stored already.
    """
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{database}` {_location(location) if location else ''}"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.user_log ({_columns(stored_log_schema(kind))}) "
        f"USING parquet {_location(log_path)}"
    )
    new = not spark.catalog.tableExists(f"`{database}`.results")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.results ({_columns(RESULT_SCHEMA)}) "
        f"USING parquet PARTITIONED BY ({', '.join(RESULT_PARTITIONS)}) {_location(results_path)}"
    )
    if new:  # days that were stored before the table was there
        ensure_results(spark, results_path)
        spark.sql(f"ALTER TABLE `{database}`.results RECOVER PARTITIONS")
    # The same "row number = 1" as latest_by_key, thinned out before the shuffle like there.
    newest_first = ", ".join(f"`{c}` DESC NULLS LAST" for c in order_columns(kind))
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS `{database}`.created_users AS "
        f"SELECT {', '.join(USER_FIELDS)} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY {newest_first}) AS nth "
        f"FROM `{database}`.user_log WHERE reason IS NULL) WHERE nth = 1"
    )
    for dimension, category in DIMENSIONS.items():
        spark.sql(
            f"CREATE VIEW IF NOT EXISTS `{database}`.`{dimension}` AS "
            f"SELECT category AS `{category}`, percentage, analysis_date "
            f"FROM `{database}`.results WHERE dimension = '{dimension}'"
        )


def publish_version(
    spark: SparkSession,
    results: DataFrame,
    path: str,
    as_of: date | str,
    database: str = DATABASE,
) -> DataFrame:
    """Replace one day for all readers of the catalog at once; returns its results.

    The rows are written whole to a folder of their own, ``path/_versions/<day>-<new id>``. Then the
    day's partitions in ``results`` are pointed there, four entries of the catalog, without a
    copy. A job that fails before has changed nothing that the table and its views show, and
    whoever is reading the old version reads on: its files stay. Readers of the folder ``path``
    itself do not see versions, nor a day that was written to it afterwards in the catalog.
    """
    day = as_of_text(as_of)
    folder = f"{qualified(spark, path)}/_versions/{day}-{uuid.uuid4().hex}"
    rows = results.where(F.col("analysis_date") == day).select(*RESULT_SCHEMA.names)
    replace_partitions(rows, folder, RESULT_PARTITIONS, [(dimension, day) for dimension in DIMENSIONS])
    for dimension in DIMENSIONS:
        partition = f"PARTITION (dimension = '{dimension}', analysis_date = '{day}')"
        place = _location(f"{folder}/dimension={dimension}/analysis_date={day}")
        spark.sql(f"ALTER TABLE `{database}`.results ADD IF NOT EXISTS {partition} {place}")
        spark.sql(f"ALTER TABLE `{database}`.results {partition} SET {place}")
    spark.sql(f"REFRESH TABLE `{database}`.results")
    return read_published(spark, as_of, database)


def read_published(spark: SparkSession, as_of: date | str, database: str = DATABASE) -> DataFrame:
    """The results of a day as the catalog has them, whichever folder they lie in."""
    rows = spark.table(f"`{database}`.results").select(*RESULT_SCHEMA.names)
    return rows.where(F.col("analysis_date") == as_of_text(as_of))


def publish_results(spark: SparkSession, as_of: date | str, database: str = DATABASE) -> None:
    """Make one day, written by path, known to the catalog: as many entries as dimensions."""
    day = as_of_text(as_of)
    partitions = " ".join(
        f"PARTITION (dimension = '{dimension}', analysis_date = '{day}')"
        for dimension in DIMENSIONS
    )
    spark.sql(f"ALTER TABLE `{database}`.results ADD IF NOT EXISTS {partitions}")
    spark.sql(f"REFRESH TABLE `{database}`.results")
    spark.sql(f"REFRESH TABLE `{database}`.user_log")
