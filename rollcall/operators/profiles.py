"""Nested raw profiles to flat user records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import hashed_uuid
from rollcall.schema import USER_FIELDS

# Fixed value: user field -> path in the raw profile ("id" and "address" are made, not read).
PROFILE_PATHS = {
    "first_name": "name.first",
    "last_name": "name.last",
    "gender": "gender",
    "post_code": "location.postcode",
    "email": "email",
    "username": "login.username",
    "dob": "dob.date",
    "registered_date": "registered.date",
    "phone": "phone",
    "picture": "picture.medium",
}


def flatten_profiles(
    profiles: DataFrame, id_from: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The 12-field user record of each nested profile, in the field order of the schema.

    Columns named in ``keep`` follow it.

    The id is a random UUID, as every poll makes a new user; ``id_from`` names profile paths
    to hash instead, which gives a replayed profile its old id, and NULL where one of them is
    NULL. The address is NULL as soon as one of its parts is (``concat_ws`` would close the gap
    and shift the parts).
    """
    path = PROFILE_PATHS
    new_id = F.uuid()
    if id_from:
        given = [F.col(c) for c in id_from]
        whole = reduce(and_, [c.isNotNull() for c in given])
        new_id = F.when(whole, hashed_uuid(*given))
    location = "location."
    address = F.concat(
        F.col(location + "street.number"),
        F.lit(" "),
        F.col(location + "street.name"),
        F.lit(", "),
        F.col(location + "city"),
        F.lit(", "),
        F.col(location + "state"),
        F.lit(", "),
        F.col(location + "country"),
    )
    return profiles.select(
        new_id.alias("id"),
        *[
            (address if field == "address" else F.col(path[field]).cast("string")).alias(field)
            for field in USER_FIELDS[1:]
        ],
        *keep,
    )


def split_profiles(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flattened profiles with a whole address, and those whose address lacks a part."""
    return users.where("address is not null"), users.where("address is null")


def classify_profiles(
    responses: DataFrame,
    id_from: Sequence[str] | None = None,
    strict: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``responses(value, profile)`` as user records with ``raw`` and ``reason``.

    A response without a profile, and a profile that lacks a path of the record, has a
    ``reason`` that names what is missing, and its text in ``raw``; both are NULL for the
    others. Only the gender may be missing: a user without one counts in the other analyses.
    ``strict`` fails the job at the first one instead. Columns named in ``carry`` come along.
    """
    kept = ["profile", "value", *carry]
    flat = flatten_profiles(responses.select("profile.*", *kept), id_from, kept)
    missing = [
        F.when(F.col(field).isNull(), F.lit(f"no {PROFILE_PATHS.get(field, field)}"))
        for field in USER_FIELDS
        if field != "gender"
    ]
    listed = F.concat_ws("; ", *missing)
    reason = F.when(F.col("profile").isNull(), F.lit("no profile")).when(listed != "", listed)
    judged = flat.withColumn("reason", reason)
    if strict:
        complaint = F.concat(F.col("reason"), F.lit(": "), F.col("value"))
        # Read through the check, so that no optimisation can take it out.
        checked = F.when(F.col("reason").isNotNull(), F.raise_error(complaint).cast("string"))
        judged = judged.withColumn("reason", checked)
    raw = F.when(F.col("reason").isNotNull(), F.col("value"))
    return judged.select(*USER_FIELDS, raw.alias("raw"), "reason", *carry)
