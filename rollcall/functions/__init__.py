"""Column expressions: built-in functions only, usable in batch and streaming plans alike."""

from rollcall.functions.bins import bin_labels
from rollcall.functions.dates import age_on, as_of_date, as_of_text, parse_dob
from rollcall.functions.ids import hashed_uuid, is_uuid
from rollcall.functions.text import (
    address_part,
    percent_label,
    raw_address_part,
    sql_literal,
    strip,
)

__all__ = [
    "address_part",
    "age_on",
    "as_of_date",
    "as_of_text",
    "bin_labels",
    "hashed_uuid",
    "is_uuid",
    "parse_dob",
    "percent_label",
    "raw_address_part",
    "sql_literal",
    "strip",
]
