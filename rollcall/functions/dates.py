"""Birth dates, ages and the analysis date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted layout of a birth date, year-month-dayThour:minute:second.fractionZ
# with one to six fraction digits. Group 1 is the calendar date; whether that day exists is
# decided by the cast. "Z" is a literal, so no time zone ever moves the day.
DOB_PATTERN = (
    r"^((?!0000)\d{4}-\d{1,2}-(?:\d{1,2}| \d))"
    r"[Tt](?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d\.\d{1,6}[Zz]\z"
)


def as_of_date(as_of: date | str) -> date:
    """The analysis date; text that is not ``yyyy-MM-dd`` of a real day is an error."""
    return as_of if isinstance(as_of, date) else date.fromisoformat(as_of)


def as_of_text(as_of: date | str) -> str:
    """The analysis date as ``yyyy-MM-dd`` text, which is how it is stored."""
    return as_of_date(as_of).strftime("%Y-%m-%d")


def parse_dob(dob: Column, strict: bool = False) -> Column:
    """Birth date out of its text. NULL where the text is not one; an error with ``strict``.

    One regular expression checks the layout and picks the date, so no session time zone takes
    part (parsing to a zoned timestamp first would lose days that a zone skipped).
    """
    day = F.regexp_extract(dob, DOB_PATTERN, 1)
    # A blank in place of a leading zero is rare: looked for only where the plain cast fails.
    without_blank = F.replace(day, F.lit(" "), F.lit(""))
    parsed = F.coalesce(day.try_cast("date"), without_blank.try_cast("date"))
    if not strict:
        return parsed
    complaint = F.concat(F.lit("not a birth date: "), F.coalesce(dob, F.lit("NULL")))
    return F.coalesce(parsed, F.raise_error(complaint).cast("date"))


def age_on(born: Column, as_of: date | str) -> Column:
    """Whole years on the ``as_of`` date; somebody born on Feb 29 turns older on Mar 1."""
    today = as_of_date(as_of)
    month_and_day = F.month(born) * 100 + F.dayofmonth(born)
    birthday_to_come = month_and_day > today.month * 100 + today.day
    return F.lit(today.year) - F.year(born) - birthday_to_come.cast("int")
