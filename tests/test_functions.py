import random
import uuid
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollcall.functions import (
    address_part,
    age_on,
    as_of_text,
    bin_labels,
    hashed_uuid,
    is_uuid,
    parse_dob,
    percent_label,
    strip,
)
from rollcall.functions.text import WHITESPACE
from rollcall.schema import AGE_EDGES, AGE_EDGES_AS_LABELLED, AGE_LABELS


DOB_FORMAT = "%Y-%m-%dT%H:%M:%S.%fZ"  # fixed value: how birth dates are written


def python_dob(text):
    try:
        return datetime.strptime(text, DOB_FORMAT).date()
    except (ValueError, TypeError):
        return None


def anniversary(born, year):
    """Birthday in a year; those born on Feb 29 turn older on Mar 1 of common years."""
    try:
        return born.replace(year=year)
    except ValueError:
        return date(year, 3, 1)


def python_age(born, today):
    """Birthdays passed since the birth; before it, birthdays still to come count down."""
    passed = sum(anniversary(born, y) <= today for y in range(born.year + 1, today.year + 1))
    ahead = sum(anniversary(born, y) > today for y in range(today.year, born.year + 1))
    return passed if born <= today else -ahead


def test_whitespace_is_what_python_strips():
    assert WHITESPACE == "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_strip_like_python(column):
    rng = random.Random(1)
    alphabet = WHITESPACE + "ab,é​﻿"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(2000)]
    assert column(texts, strip) == [text.strip() for text in texts]


@pytest.mark.parametrize(
    "address, country, city",
    [
        ("1 A St, City, State, Country\t", "Country", "State"),
        ("1 A St, City, State, Country", "Country", "State"),
        ("a,b,", "", "b"),
        ("nocomma", "nocomma", None),
        ("", "", None),
        (None, None, None),
    ],
)
def test_address_parts(column, address, country, city):
    assert column([address], lambda c: address_part(c, -1)) == [country]
    assert column([address], lambda c: address_part(c, -2)) == [city]


def test_strict_address_part_fails(column):
    assert column(["x, y"], lambda c: address_part(c, -2, strict=True)) == ["x"]
    for bad in ("nocomma", None):
        with pytest.raises(PySparkException, match="no part -2"):
            column([bad], lambda c: address_part(c, -2, strict=True))


def test_address_position_counts_from_the_end(spark):
    with pytest.raises(ValueError):
        address_part(F.lit("a"), 0)


FIXED_DOBS = [
    "1990-02-03T04:05:06.789Z",
    "1990-2-3T4:5:6.7Z",
    "1990-02-03t04:05:06.789z",
    "1990-02- 3T04:05:06.789Z",
    "1990-02-03T04:05:06Z",
    "1990-02-03T04:05:06.1234567Z",
    "1990-02-03",
    "1990-02-03T04:05:06.789+00:00",
    " 1990-02-03T04:05:06.789Z",
    "1990-02-03T04:05:06.789Z\n",
    "2023-02-29T00:00:00.0Z",
    "2024-02-29T00:00:00.0Z",
    "0000-01-01T00:00:00.0Z",
    "0001-01-01T00:00:00.0Z",
    "9999-12-31T23:59:59.999999Z",
    "1990-00-03T04:05:06.789Z",
    "1990-13-03T04:05:06.789Z",
    "1990-02-03T24:05:06.789Z",
    "1990-02-03T04:60:06.789Z",
    "1990-02-03T04:05:60.789Z",
    "90-02-03T04:05:06.789Z",
    "",
    None,
]


def test_birth_dates_like_python(column):
    rng = random.Random(2)
    made = []
    for _ in range(3000):
        y, mo, d = rng.randint(1, 9999), rng.randint(0, 13), rng.randint(0, 32)
        h, mi, s = rng.randint(0, 25), rng.randint(0, 61), rng.randint(0, 62)
        pad = rng.choice(["02", "01", "1", "02"])
        fraction = "".join(rng.choices("0123456789", k=rng.randint(1, 7)))
        made.append(
            f"{y:04}-{mo:{pad}}-{d:{pad}}T{h:{pad}}:{mi:{pad}}:{s:{pad}}.{fraction}Z"
        )
    texts = FIXED_DOBS + made
    expected = [python_dob(text) for text in texts]
    assert sum(e is not None for e in expected) > 1000
    assert column(texts, parse_dob) == expected


@pytest.mark.parametrize("zone", ["America/New_York", "Pacific/Apia", "Asia/Tokyo"])
def test_session_zone_never_moves_a_birth_date(spark, column, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Samoa had no December 30 in 2011.
        texts = ["1990-02-03T02:00:00.000Z", "2011-12-30T12:00:00.0Z", "2024-03-10T02:30:00.0Z"]
        assert column(texts, parse_dob) == [python_dob(text) for text in texts]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_birth_date_fails(column):
    for bad in ("1990-02-03", None):
        with pytest.raises(PySparkException, match="not a birth date"):
            column([bad], lambda c: parse_dob(c, strict=True))


@pytest.mark.parametrize(
    "born, as_of, age",
    [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-02-28", "2023-02-28", 23),
        ("2000-01-31", "2023-01-30", 22),
        ("2030-01-01", "2023-06-01", -7),
    ],
)
def test_ages(column, born, as_of, age):
    assert column([born], lambda c: age_on(c.cast("date"), as_of)) == [age]


def test_ages_like_python(column):
    rng = random.Random(3)
    days = [date(1900, 1, 1) + timedelta(days=rng.randint(0, 60000)) for _ in range(2000)]
    for as_of in (date(2023, 2, 28), date(2024, 2, 29), date(2024, 12, 31)):
        expected = [python_age(day, as_of) for day in days]
        found = column(days, lambda c: age_on(c, as_of), "date")
        assert found == expected


def test_bins_like_pandas(column):
    ages = [-1, 0, 1, 15, 16, 17, 30, 31, 32, 45, 46, 47, 59, 60, 61, 150, 151, None]
    cut = pd.cut(pd.Series(ages, dtype="float"), bins=list(AGE_EDGES), labels=list(AGE_LABELS))
    expected = [None if pd.isna(label) else label for label in cut]
    assert column(ages, lambda c: bin_labels(c, AGE_EDGES, AGE_LABELS), "int") == expected
    assert expected[3:6] == ["0-15", "0-15", "16-30"]


def test_bins_as_labelled(column):
    def bins(c):
        return bin_labels(c, AGE_EDGES_AS_LABELLED, AGE_LABELS)

    found = column([0, 15, 16, 60, 61], bins, "int")
    assert found == ["0-15", "0-15", "16-30", "46-60", "60+"]


def test_bins_reject_bad_edges(spark):
    for edges in ((0, 1), (0, 2, 1)):
        with pytest.raises(ValueError):
            bin_labels(F.lit(1), edges, ("a", "b"))


def test_percent_labels_like_python(column):
    rng = random.Random(4)
    values = [0.0, 0.5, 1.5, 2.5, 12.5, 12.500001, 33.333, 99.5, 100.0, 0.49999999999999994]
    values += [n / 2 for n in range(200)] + [rng.random() * 100 for _ in range(500)]
    assert column(values, percent_label, "double") == [f"{v:.0f}%" for v in values]
    assert column([None], percent_label, "double") == [None]


def test_uuid_check(column):
    good = [str(uuid.uuid4()), str(uuid.uuid4()).upper()]
    bad = ["", "a", good[0] + "0", good[0][:-1], good[0] + "\n", good[0].replace("-", "_")]
    expected = [True] * len(good) + [False] * len(bad) + [None]
    assert column(good + bad + [None], is_uuid) == expected


def test_hashed_uuid(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "x"), ("", "x"), ("a", "bc")]
    df = spark.createDataFrame(rows, "p string, q string")
    ids = [r[0] for r in df.select(hashed_uuid(F.col("p"), F.col("q"))).collect()]
    assert ids[0] == ids[4]
    assert len(set(ids)) == 4
    assert all(str(uuid.UUID(i)) == i and uuid.UUID(i).version == 8 for i in ids)


def test_as_of():
    assert as_of_text(date(2024, 6, 30)) == as_of_text("2024-06-30") == "2024-06-30"
    with pytest.raises(ValueError):
        as_of_text("2024-02-30")
