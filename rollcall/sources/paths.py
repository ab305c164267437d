"""One spelling for every path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme and authority, as the catalog stores locations.

    ``/lake/x``, ``/lake//x/`` and ``hdfs://host/lake/x`` are one folder where that is the
    default file system; a relative path counts from the file system's working directory.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.makeQualified(hadoop).toString()
