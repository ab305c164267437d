"""Changes to the keyed user table since its last snapshot, batch by batch, in the same buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.keyed import latest_by_key, upsert_by_key
from rollcall.schema import LOG_PARTITIONS, USER_FIELDS, order_columns, snapshot_schema, stored_log_schema
from rollcall.sources.log import read_user_log
from rollcall.sources.users import Snapshot, read_snapshot, write_snapshot


def ensure_changes(spark: SparkSession, table: str, buckets: int, kind: str = "kafka") -> None:
    """Create the table of changes if it is missing: per batch one row of every user in it.

    It is bucketed by id like the snapshots it is read with, which must have as many ``buckets``:
    then neither side of that join moves. The catalog owns its files, below its database.
    """
    kept = [*snapshot_schema(kind).names, *LOG_PARTITIONS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored_log_schema(kind) if f.name in kept)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(LOG_PARTITIONS)}) CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS"
    )


def add_changes(spark: SparkSession, log_path: str, batch: str, table: str, kind: str = "kafka") -> None:
    """Add the last row of every user in one batch of the log; adding it again replaces it."""
    log = read_user_log(spark, log_path, kind).where((F.col("batch") == batch) & F.col("reason").isNull())
    names = [*snapshot_schema(kind).names, *LOG_PARTITIONS]
    rows = latest_by_key(log.select(*names), ["id"], order_columns(kind))
    rows.createOrReplaceTempView("_batch_of_changes")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(LOG_PARTITIONS)}) "
            f"SELECT {', '.join(f'`{c}`' for c in names)} FROM _batch_of_changes"
        )
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def read_changes(spark: SparkSession, table: str, kind: str = "kafka") -> DataFrame:
    """The last row of every user that has changed; from its buckets, without a shuffle."""
    rows = spark.table(table).select(*snapshot_schema(kind).names)
    return latest_by_key(rows, ["id"], order_columns(kind))


def current_users(
    spark: SparkSession, changes: str, snapshot: Snapshot | None = None, kind: str = "kafka"
) -> DataFrame:
    """The keyed table as of now: the snapshot with the changes since written over it.

    With as many buckets on both sides nothing is shuffled, and only the changes are sorted.
    """
    newest = read_changes(spark, changes, kind)
    if snapshot is None:
        return newest
    return upsert_by_key(read_snapshot(spark, snapshot, kind), newest, ["id"], order_columns(kind))


def fold_changes(
    spark: SparkSession,
    changes: str,
    snapshot: Snapshot,
    previous: Snapshot | None = None,
    kind: str = "kafka",
) -> DataFrame:
    """Write ``previous`` with all changes as a new ``snapshot``, and drop these changes.

    Batches that arrive meanwhile stay for the next time. A job that fails before the changes are
    dropped may run again: a change that the snapshot holds already ties against itself. The
    snapshot gets the buckets of the changes.
    """
    if previous is not None and previous.path == snapshot.path:
        raise ValueError("a snapshot cannot replace the one it is made from")
    batches = [row.partition for row in spark.sql(f"SHOW PARTITIONS {changes}").collect()]
    values = [dict(part.split("=", 1) for part in batch.split("/")) for batch in batches]
    rows = spark.table(changes).where(F.col("batch").isin([v["batch"] for v in values]))
    users = latest_by_key(rows.select(*snapshot_schema(kind).names), ["id"], order_columns(kind))
    if previous is not None:
        users = upsert_by_key(read_snapshot(spark, previous, kind), users, ["id"], order_columns(kind))
    described = spark.sql(f"DESCRIBE FORMATTED {changes}").where("col_name = 'Num Buckets'")
    folded = write_snapshot(users, snapshot, kind, previous, int(described.first().data_type))
    for v in values:
        spark.sql(
            f"ALTER TABLE {changes} DROP IF EXISTS PARTITION "
            f"(ingest_date = '{v['ingest_date']}', batch = '{v['batch']}')"
        )
    return folded


def publish_current_users(
    spark: SparkSession, changes: str, database: str, snapshot: Snapshot | None = None, kind: str = "kafka"
) -> None:
    """Let the view ``created_users`` show the snapshot with the changes, not the sorted log.

    To be called whenever ``fold_changes`` has written a new snapshot, which needs a table name.
    """
    order = order_columns(kind)
    newest_first = ", ".join(f"`{c}` DESC NULLS LAST" for c in order)
    newest = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {newest_first}) AS nth "
        f"FROM {changes}) WHERE nth = 1"
    )
    if snapshot is None:
        body = f"SELECT {', '.join(USER_FIELDS)} FROM ({newest})"
    else:
        moment = {side: f"struct({', '.join(f'{side}.`{c}`' for c in order)})" for side in ("o", "n")}
        keep = f"n.id IS NULL OR (o.id IS NOT NULL AND {moment['o']} > {moment['n']})"
        fields = ", ".join(f"CASE WHEN {keep} THEN o.`{c}` ELSE n.`{c}` END AS `{c}`" for c in USER_FIELDS)
        body = f"SELECT {fields} FROM {snapshot.table} o FULL OUTER JOIN ({newest}) n ON o.id = n.id"
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.created_users AS {body}")
