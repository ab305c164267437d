"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points str.strip() takes off, which are more than SQL trim's space.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def sql_literal(text: str) -> str:
    """A text as it is written in a SQL statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: Column) -> Column:
    """Take every kind of Unicode whitespace off both ends (SQL ``trim`` takes spaces only).

    A trim over a set of characters gives the same answer as a ``(?U)\\s`` regular expression
    on all of them but the separators U+001C..U+001F, which the expression misses, and costs
    about half of it.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def raw_address_part(address: Column, position: int, strict: bool = False) -> Column:
    """The comma-separated part of an address at ``position``, counted from the end, as it is.

    NULL where there is no such part; with ``strict`` such a row fails the job.
    """
    if position >= 0:
        raise ValueError(f"position counts from the end and must be negative, not {position}")
    part = F.try_element_at(F.split(address, ","), F.lit(position))
    if not strict:
        return part
    complaint = F.concat(
        F.lit(f"address has no part {position}: "), F.coalesce(address, F.lit("NULL"))
    )
    return F.coalesce(part, F.raise_error(complaint).cast("string"))


def address_part(address: Column, position: int, strict: bool = False) -> Column:
    """The part of an address at ``position`` from the end, stripped."""
    return strip(raw_address_part(address, position, strict))


def percent_label(percentage: Column) -> Column:
    """``12.5`` -> ``12%``: no decimals, ties to even (``format_string`` would round up)."""
    return F.concat(F.bround(percentage, 0).cast("bigint").cast("string"), F.lit("%"))
