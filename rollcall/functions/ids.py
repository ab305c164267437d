"""User ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: textual layout of a UUID.
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"


def is_uuid(text: Column) -> Column:
    """Whether a text is a UUID (Spark has no such type); NULL for NULL."""
    return text.rlike(UUID_PATTERN)


def hashed_uuid(*columns: Column) -> Column:
    """A UUID that depends on nothing but the values, so replays and retries repeat it.

    The values go through JSON first, so that ('a', 'bc') and ('ab', 'c') or NULL and ''
    differ. Version 8 of RFC 9562 marks ids of one's own making.
    """
    named = [column.alias(f"c{i}") for i, column in enumerate(columns)]
    digest = F.md5(F.to_json(F.struct(*named), {"ignoreNullFields": "false"}).cast("binary"))
    return F.concat_ws(
        "-",
        F.substr(digest, F.lit(1), F.lit(8)),
        F.substr(digest, F.lit(9), F.lit(4)),
        F.concat(F.lit("8"), F.substr(digest, F.lit(14), F.lit(3))),
        F.concat(F.lit("8"), F.substr(digest, F.lit(18), F.lit(3))),
        F.substr(digest, F.lit(21), F.lit(12)),
    )
