"""Schemas and fixed values shared by every module.

Everything below the "Fixed values" line decides a result: labels, edges, names and formats
that stored data and charts already use. They are kept together here and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# --- Fixed values -------------------------------------------------------------------------

USER_FIELDS = (
    "id",
    "first_name",
    "last_name",
    "gender",
    "address",
    "post_code",
    "email",
    "username",
    "dob",
    "registered_date",
    "phone",
    "picture",
)

TOPIC = "users_created"
DATABASE = "spark_streams"

# Right-closed bins. The labels read like 0..15, 16..30, ... but the edges of the stored
# history are these, so a 16-year-old is counted in "0-15" and a 60-year-old in "46-60".
AGE_LABELS = ("0-15", "16-30", "31-45", "46-60", "60+")
AGE_EDGES = (0, 16, 31, 46, 60, 150)
# What the labels say, for whoever prefers it; never the default.
AGE_EDGES_AS_LABELLED = (-1, 15, 30, 45, 60, 150)

# Address layout: "<number> <street>, <city>, <state>, <country>", counted from the end.
# The dimension called "city" has always been part -2, which is the state; -3 is the city.
COUNTRY_PART = -1
CITY_PART = -2

# dimension -> (name of the category column in its result table)
DIMENSIONS = {
    "age": "age_group",
    "gender": "gender",
    "city": "city",
    "country": "country",
}

# dimension -> (x axis, title, file name); "city" has no chart.
CHARTS = {
    "age": ("Age Group", "Percentage Distribution by Age Group", "age_distribution.png"),
    "gender": ("Gender", "Percentage Distribution by Gender", "gender_distribution.png"),
    "country": ("Country", "Percentage Distribution by Country", "country_distribution.png"),
}
CHART_Y_LABEL = "Percentage"
# More categories than this turn the tick labels upright and need a taller bottom margin.
CHART_UPRIGHT_ABOVE = 20

# --- Schemas ------------------------------------------------------------------------------

USER_SCHEMA = T.StructType(_strings(*USER_FIELDS))

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StructType(_strings("first", "last"))),
        T.StructField("gender", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("street", T.StructType(_strings("number", "name"))),
                    *_strings("city", "state", "country", "postcode"),
                ]
            ),
        ),
        T.StructField("email", T.StringType()),
        T.StructField("login", T.StructType(_strings("username"))),
        T.StructField("dob", T.StructType(_strings("date"))),
        T.StructField("registered", T.StructType(_strings("date"))),
        T.StructField("phone", T.StringType()),
        T.StructField("picture", T.StructType(_strings("medium"))),
    ]
)

# One landed API response: the profiles sit in an array.
RESPONSE_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(PROFILE_SCHEMA))])

# Columns that say which of two messages about the same user is the later one. They travel
# from the source into the log, so the order survives restarts and compaction.
ORDER_SCHEMAS = {
    "kafka": T.StructType(
        [
            T.StructField("timestamp", T.TimestampType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    ),
    "files": T.StructType([T.StructField("seq", T.LongType())]),
}

# Folders of the log: the day on which a batch was ingested, and the batch.
LOG_PARTITION_SCHEMA = T.StructType(
    [T.StructField("ingest_date", T.DateType()), T.StructField("batch", T.StringType())]
)
LOG_PARTITIONS = tuple(LOG_PARTITION_SCHEMA.names)

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.BinaryType())])

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("percentage", T.DoubleType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("analysis_date", T.StringType()),
    ]
)
# Counts behind the results: the age of a user is kept as the day of birth.
BORN = "born"
COUNT_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("analysis_date", T.StringType()),
    ]
)
RESULT_PARTITIONS = ("dimension", "analysis_date")
RESULT_KEY = ("dimension", "analysis_date", "category")


def order_columns(kind: str) -> list[str]:
    """Names of the order columns of a message source ("kafka" or "files")."""
    return ORDER_SCHEMAS[kind].names


def message_schema(kind: str) -> T.StructType:
    """Schema of the messages a source delivers: the bytes and the order columns."""
    return T.StructType([*MESSAGE_SCHEMA.fields, *ORDER_SCHEMAS[kind].fields])


def snapshot_schema(kind: str) -> T.StructType:
    """Schema of the keyed user table: order columns and the 12 user fields."""
    return T.StructType([*ORDER_SCHEMAS[kind].fields, *USER_SCHEMA.fields])


def log_schema(kind: str) -> T.StructType:
    """Schema of the append log: the snapshot columns, and why a message was refused."""
    return T.StructType([*snapshot_schema(kind).fields, *_strings("raw", "reason")])


def stored_log_schema(kind: str) -> T.StructType:
    """Schema of the log as it is read: its columns, and the folders they lie in."""
    return T.StructType([*log_schema(kind).fields, *LOG_PARTITION_SCHEMA.fields])
