"""User data derived from the test tables; every row of the source table is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import encode_users

AS_OF = "2024-06-30"
NEXT_DAY = "2024-07-01"
DECLARED_EVENT_TYPES = ["signup", "click", "view", "purchase", "refund"]

# Known beforehand, so that no job has to look into the files for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation and region; the optimiser broadcasts the small sides."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, _same("c_nationkey", "n_nationkey"))
        .join(region, _same("n_regionkey", "r_regionkey"))
    )


def _same(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def uuid_of(key: str) -> str:
    return f"concat('00000000-0000-4000-8000-', lpad(cast({key} as string), 12, '0'))"


_GENDER = (
    "case when c_custkey % 97 = 0 then null when c_custkey % 3 = 0 then 'male' "
    "else 'female' end"
)
_BORN = "cast(date_add(date'1930-01-01', cast(c_custkey * 7919 % 36000 as int)) as string)"
_JOINED = "cast(date_add(date'2010-01-01', cast(c_custkey * 31 % 5000 as int)) as string)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, gender, address, dob`` of one user per customer."""
    return _people(spark, sf_dir).selectExpr(
        f"{uuid_of('c_custkey')} as id",
        f"{_GENDER} as gender",
        "concat(cast(c_custkey % 900 + 1 as string), ' Main St, CITY_', "
        "cast(c_custkey % 50 as string), ', ', r_name, ', ', n_name) as address",
        f"concat({_BORN}, 'T04:05:06.789Z') as dob",
    )


def full_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 12 fields of one user per customer, and ``seq``."""
    return _people(spark, sf_dir).selectExpr(
        f"{uuid_of('c_custkey')} as id",
        "c_mktsegment as first_name",
        "c_name as last_name",
        f"{_GENDER} as gender",
        "concat(cast(c_custkey % 900 + 1 as string), ' Main St, CITY_', "
        "cast(c_custkey % 50 as string), ', ', r_name, ', ', n_name) as address",
        "cast(10000 + c_custkey % 90000 as string) as post_code",
        "concat('user', cast(c_custkey as string), '@example.com') as email",
        "concat('user', cast(c_custkey as string)) as username",
        f"concat({_BORN}, 'T04:05:06.789Z') as dob",
        f"concat({_JOINED}, 'T10:11:12.345Z') as registered_date",
        "concat('555-', cast(c_custkey as string)) as phone",
        "concat('https://example.com/', cast(c_custkey as string), '.jpg') as picture",
        "c_custkey as seq",
    )


def user_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One changed profile per order, for the ordering customer; ``seq`` follows the date."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{uuid_of('o_custkey')} as id",
        "o_orderstatus as first_name",
        "cast(o_orderkey as string) as last_name",
        "case when o_custkey % 97 = 0 then null when o_custkey % 3 = 0 then 'male' "
        "else 'female' end as gender",
        "concat(cast(o_orderkey % 900 + 1 as string), ' Side St, CITY_', "
        "cast(o_orderkey % 50 as string), ', ', o_orderpriority, ', NATION_', "
        "cast(o_custkey % 25 as string)) as address",
        "cast(o_orderkey % 99999 as string) as post_code",
        "concat('user', cast(o_custkey as string), '@example.com') as email",
        "concat('user', cast(o_custkey as string)) as username",
        "concat(cast(date_add(date'1930-01-01', cast(o_custkey * 7919 % 36000 as int)) "
        "as string), 'T04:05:06.789Z') as dob",
        "concat(cast(cast(o_orderdate as date) as string), 'T00:00:00.0Z') as registered_date",
        "concat('555-', cast(o_orderkey as string)) as phone",
        "cast(null as string) as picture",
        f"{update_seq('o_orderdate')} as seq",
        "o_orderdate",
    )


def update_seq(day: str) -> str:
    """Date first, order key within the date; later than any customer's own message."""
    return f"datediff(cast({day} as date), date'1990-01-01') * 1000000000000L + o_orderkey"


def messages(records: DataFrame) -> DataFrame:
    """Users as the messages a topic would hold."""
    return encode_users(records, ["seq"])


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, in ten shapes from impeccable to absent."""
    event_uuid = uuid_of("event_id")
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""cast(case event_id % 10
        when 0 then concat('{{"id":"', {event_uuid}, '","gender":"', event_type,
                           '","post_code":', cast(event_id as string), ',"extra":', props, '}}')
        when 1 then concat('{{"id":"', {event_uuid}, '","post_code":', props, ',"dob":null}}')
        when 2 then concat('{{"id":"', {event_uuid}, '"}}')
        when 3 then concat('{{"id":"ABCDEF', substr({event_uuid}, 7), '","gender":""}}')
        when 4 then concat('{{"id":"', event_type, '","gender":"', event_type, '"}}')
        when 5 then concat('{{"id":null,"ID":"', {event_uuid}, '"}}')
        when 6 then event_type
        when 7 then concat('{{"id":"', {event_uuid}, '",')
        when 8 then concat('[{{"id":"', {event_uuid}, '"}}]')
        when 9 then case when event_id % 20 = 9 then '' end
        end as binary) as value""",
    )


def event_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, address, dob`` per event, with eight spellings of a date and six of an address."""
    return table(spark, sf_dir, "events").selectExpr(
        f"{uuid_of('event_id')} as id",
        """case event_id % 6
        when 0 then concat('1 A St, City, State ', event_type, ', Country\\t')
        when 1 then concat('2 B St, City,\\u00a0', event_type, ' ,\\u2003Land\\u00a0')
        when 2 then 'nocomma'
        when 3 then ''
        when 4 then null
        when 5 then concat('a,', event_type, ',')
        end as address""",
        """case event_id % 8
        when 0 then concat(cast(cast(ts as date) as string), 'T04:05:06.789Z')
        when 1 then concat(cast(cast(ts as date) as string), 't4:5:6.7z')
        when 2 then concat(cast(cast(ts as date) as string), 'T04:05:06Z')
        when 3 then concat(cast(cast(ts as date) as string), 'T04:05:06.1234567Z')
        when 4 then concat(cast(cast(ts as date) as string), 'T04:05:06.789+00:00')
        when 5 then concat(' ', cast(cast(ts as date) as string), 'T04:05:06.789Z')
        when 6 then '2023-02-29T04:05:06.789Z'
        when 7 then null
        end as dob""",
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw profiles, one per customer, with numbers where the API sends numbers."""
    return _people(spark, sf_dir).selectExpr(
        "named_struct('first', c_mktsegment, 'last', c_name) as name",
        f"{_GENDER} as gender",
        """named_struct(
            'street', named_struct('number', c_custkey % 900 + 1, 'name', 'Main St'),
            'city', concat('CITY_', cast(c_custkey % 50 as string)),
            'state', case when c_custkey % 41 = 0 then null else r_name end,
            'country', n_name,
            'postcode', 10000 + c_custkey % 90000) as location""",
        "concat('user', cast(c_custkey as string), '@example.com') as email",
        "named_struct('username', concat('user', cast(c_custkey as string))) as login",
        f"named_struct('date', concat({_BORN}, 'T04:05:06.789Z'), 'age', 1) as dob",
        f"named_struct('date', concat({_JOINED}, 'T10:11:12.345Z')) as registered",
        "concat('555-', cast(c_custkey as string)) as phone",
        "named_struct('medium', concat('https://example.com/', cast(c_custkey as string), "
        "'.jpg'), 'large', 'x') as picture",
    )
