"""The keyed user table: the append log, resolved at read, and snapshots of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.keyed import latest_by_key, upsert_by_key
from rollcall.schema import USER_FIELDS, order_columns, snapshot_schema
from rollcall.sources.log import read_user_log
from rollcall.sources.paths import qualified

#: Ids looked up by a list, which leaves out buckets and files; more of them are joined.
MOST_LOOKED_UP = 10_000


@dataclass(frozen=True)
class Snapshot:
    """Where a snapshot lies, and the catalog table, if any, that knows its buckets."""

    path: str
    table: str | None = None


def latest_users(
    spark: SparkSession,
    path: str,
    kind: str = "kafka",
    columns: Sequence[str] = USER_FIELDS,
) -> DataFrame:
    """The last written row of every user in the log.

    Name the ``columns`` you need: the others are neither read nor shuffled.
    """
    log = read_user_log(spark, path, kind).where("reason is null")
    wanted = ["id", *[c for c in columns if c != "id"], *order_columns(kind)]
    return latest_by_key(log.select(*wanted), ["id"], order_columns(kind)).select(*columns)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table, empty if it has none."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
    return {row.col_name: row.data_type for row in rows}


def _is_table_of(spark: SparkSession, snapshot: Snapshot) -> bool:
    """Whether the catalog's table of that name lies in the snapshot's own folder."""
    if snapshot.table is None:
        return False
    location = _described(spark, snapshot.table).get("Location")
    return location is not None and qualified(spark, location) == qualified(spark, snapshot.path)


def read_snapshot(spark: SparkSession, snapshot: Snapshot, kind: str = "kafka") -> DataFrame:
    """A snapshot made by ``compact_users``: one row per user.

    Read as a table where the catalog has it in that folder, so that joins on the id find its
    buckets, and from the folder otherwise: a table of the same name may be another pipeline's.
    """
    if _is_table_of(spark, snapshot):
        return spark.table(snapshot.table)
    return spark.read.schema(snapshot_schema(kind)).parquet(snapshot.path)


def compact_users(
    spark: SparkSession,
    log_path: str,
    snapshot: Snapshot,
    kind: str = "kafka",
    previous: Snapshot | None = None,
    since: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write the keyed table to its own folder and return it, read back from there.

    With a ``previous`` snapshot only log rows that satisfy ``since`` are read again: a condition
    on the files (``written_since``) or on the order columns, pushed down either way. Being
    too generous there does no harm: rows that the snapshot already holds lose or tie against
    themselves. A folder left over by an earlier attempt is replaced; ``previous`` must be
    another one.

    A snapshot with a table name is bucketed by id: the next day's merge then shuffles the new
    log rows only, never the snapshot. ``buckets`` says into how many, about one for each
    gigabyte that the table will grow to; left out, the previous snapshot's number is kept, and
    the first one takes as many as a shuffle has partitions. A table of that name over another
    folder is not replaced but refused.

    Everything of a day reads the snapshot, so the log is deduplicated once; and since it is a
    written table, lost executors never cause the log to be read again.
    """
    if previous is not None and previous.path == snapshot.path:
        raise ValueError("a snapshot cannot replace the one it is made from")
    order = order_columns(kind)
    log = read_user_log(spark, log_path, kind).where("reason is null")
    if since is not None:
        log = log.where(since)
    users = latest_by_key(log.select(*snapshot_schema(kind).names), ["id"], order)
    if previous is not None:
        users = upsert_by_key(read_snapshot(spark, previous, kind), users, ["id"], order)
    return write_snapshot(users, snapshot, kind, previous, buckets)


def write_snapshot(
    users: DataFrame,
    snapshot: Snapshot,
    kind: str = "kafka",
    previous: Snapshot | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write ``users``, one row per id, as a snapshot, and return it as it is read.

    Rows lie sorted by id in their bucket, with a Bloom filter on the id, so that a lookup opens
    one bucket and skips the row groups that cannot hold the id. See ``compact_users``.
    """
    spark = users.sparkSession
    path = qualified(spark, snapshot.path)
    writer = (
        users.write.mode("overwrite").format("parquet")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    if snapshot.table is None:
        writer.save(path)
        return read_snapshot(spark, snapshot, kind)
    if _described(spark, snapshot.table) and not _is_table_of(spark, snapshot):
        raise ValueError(f"{snapshot.table} is the table of another folder")
    if buckets is None and previous is not None and _is_table_of(spark, previous):
        buckets = int(_described(spark, previous.table).get("Num Buckets", 0)) or None
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = writer.bucketBy(buckets, "id").sortBy("id").option("path", path)
    writer.saveAsTable(snapshot.table)
    return read_snapshot(spark, snapshot, kind)


def users_by_id(
    spark: SparkSession, snapshot: Snapshot, ids: Sequence[str] | DataFrame, kind: str = "kafka"
) -> DataFrame:
    """The rows of a snapshot with these ids: UUIDs in any case, or a frame with a column ``id``.

    A list of ids selects buckets, and within their files the row groups that may hold one. A
    frame of at most ``MOST_LOOKED_UP`` different ids becomes such a list; a longer one
    is joined, which moves the ids and not the snapshot. Ids that no user has give no row.
    """
    users = read_snapshot(spark, snapshot, kind)
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.lower("id").alias("id")).where("id is not null").distinct()
        found = wanted.limit(MOST_LOOKED_UP + 1).collect()
        if len(found) > MOST_LOOKED_UP:
            return users.join(wanted, "id", "left_semi")
        ids = [row.id for row in found]
    return users.where(F.col("id").isin([i.lower() for i in ids]))
