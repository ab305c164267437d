"""User records to JSON messages and back. Map-only: the same code serves batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import is_uuid
from rollcall.schema import USER_FIELDS, USER_SCHEMA

_CORRUPT = "_corrupt_record"


def encode_users(users: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One message per user: ``value`` holds UTF-8 JSON with every field, NULL ones included."""
    record = F.struct(*USER_FIELDS)
    json = F.to_json(record, {"ignoreNullFields": "false"})
    return users.select(*carry, json.cast("binary").alias("value"))


def decode_users(
    messages: DataFrame, carry: Sequence[str] = (), schema: T.StructType = USER_SCHEMA
) -> DataFrame:
    """Fields of the JSON in ``value``; whatever cannot be read is NULL and no row is lost."""
    text = F.col("value").cast("string")
    return messages.select(*carry, F.from_json(text, schema).alias("data")).select(
        *carry, "data.*"
    )


def classify_users(messages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Decode, and say in ``reason`` why a message cannot become a row of the keyed table.

    ``reason`` is NULL for a good message, whose id is then in canonical lower case: the table
    is keyed by the UUID, not by its spelling. ``raw`` keeps the text of a refused message.
    One JSON parse per message, no shuffle.
    """
    read_schema = T.StructType([*USER_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    data = F.from_json(text, read_schema, {"columnNameOfCorruptRecord": _CORRUPT})
    # As the only element of an exploded array the parsed record is a row of its own, and a
    # later filter on it stays above; from a plain column the optimiser would push the filter
    # below and parse every message once more for it.
    parsed = messages.select(*carry, text.alias("raw"), F.explode(F.array(data)).alias("data"))
    judged = parsed.withColumn("reason", _refusal(F.col("data")))
    good = F.col("reason").isNull()
    return judged.select(
        *carry,
        F.when(good, F.lower("data.id")).otherwise(F.col("data.id")).alias("id"),
        *[F.col(f"data.{field}").alias(field) for field in USER_FIELDS[1:]],
        F.when(~good, F.col("raw")).alias("raw"),
        "reason",
    )


def _refusal(data: Column) -> Column:
    return (
        F.when(data.isNull(), "empty message")
        .when(data[_CORRUPT].isNotNull(), "malformed message")
        .when(data["id"].isNull(), "no id")
        .when(~is_uuid(data["id"]), "id is not a UUID")
    )


def split_valid(
    messages: DataFrame, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Users that may enter the keyed table, and refused messages with text and reason."""
    classified = classify_users(messages, carry)
    valid = classified.where("reason is null").select(*carry, *USER_FIELDS)
    refused = classified.where("reason is not null").select(*carry, "raw", "reason")
    return valid, refused
