"""A local session for tests, comparison and benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
