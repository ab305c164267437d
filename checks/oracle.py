"""The same queries in DuckDB SQL, each written from the definition of the operator."""

from __future__ import annotations

from checks.tables import AS_OF, NEXT_DAY

# --- derived tables --------------------------------------------------------------------------


def _uuid(key: str) -> str:
    return f"('00000000-0000-4000-8000-' || lpad(CAST({key} AS VARCHAR), 12, '0'))"


def _days_after(start: str, expression: str) -> str:
    return f"CAST(DATE '{start}' + CAST({expression} AS INTEGER) AS VARCHAR)"


_GENDER = (
    "CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'male' ELSE 'female' END"
)
_PEOPLE = (
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
_STREET = "(CAST(c_custkey % 900 + 1 AS VARCHAR) || ' Main St')"
_CITY = "('CITY_' || CAST(c_custkey % 50 AS VARCHAR))"
_ADDRESS = f"({_STREET} || ', ' || {_CITY} || ', ' || r_name || ', ' || n_name)"
_DOB = f"({_days_after('1930-01-01', 'c_custkey * 7919 % 36000')} || 'T04:05:06.789Z')"

_USERS = f"""users AS (
  SELECT {_uuid('c_custkey')} AS id, {_GENDER} AS gender, {_ADDRESS} AS address, {_DOB} AS dob
  FROM {_PEOPLE})"""

_REST = f"""'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
    'user' || CAST(c_custkey AS VARCHAR) AS username,
    {_DOB} AS dob,
    {_days_after('2010-01-01', 'c_custkey * 31 % 5000')} || 'T10:11:12.345Z' AS registered_date,
    '555-' || CAST(c_custkey AS VARCHAR) AS phone,
    'https://example.com/' || CAST(c_custkey AS VARCHAR) || '.jpg' AS picture"""

_FULL_USERS = f"""full_users AS (
  SELECT {_uuid('c_custkey')} AS id, c_mktsegment AS first_name, c_name AS last_name,
    {_GENDER} AS gender, {_ADDRESS} AS address,
    CAST(10000 + c_custkey % 90000 AS VARCHAR) AS post_code, {_REST},
    c_custkey AS seq
  FROM {_PEOPLE})"""

_FIELDS = (
    "id, first_name, last_name, gender, address, post_code, email, username, dob, "
    "registered_date, phone, picture"
)

_UPDATES = f"""updates AS (
  SELECT {_uuid('o_custkey')} AS id, o_orderstatus AS first_name,
    CAST(o_orderkey AS VARCHAR) AS last_name,
    CASE WHEN o_custkey % 97 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 'male'
      ELSE 'female' END AS gender,
    CAST(o_orderkey % 900 + 1 AS VARCHAR) || ' Side St, CITY_' ||
      CAST(o_orderkey % 50 AS VARCHAR) || ', ' || o_orderpriority || ', NATION_' ||
      CAST(o_custkey % 25 AS VARCHAR) AS address,
    CAST(o_orderkey % 99999 AS VARCHAR) AS post_code,
    'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email,
    'user' || CAST(o_custkey AS VARCHAR) AS username,
    {_days_after('1930-01-01', 'o_custkey * 7919 % 36000')} || 'T04:05:06.789Z' AS dob,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00.0Z' AS registered_date,
    '555-' || CAST(o_orderkey AS VARCHAR) AS phone,
    CAST(NULL AS VARCHAR) AS picture,
    CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS BIGINT)
      * 1000000000000 + o_orderkey AS seq
  FROM orders)"""

# The log of customers' own messages and order updates, and its last row per user.
_LATEST = f"""{_FULL_USERS}, {_UPDATES},
log AS (SELECT {_FIELDS}, seq FROM full_users UNION ALL SELECT {_FIELDS}, seq FROM updates),
latest AS (
  SELECT {_FIELDS} FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS nth FROM log)
  WHERE nth = 1)"""

_EVENT_UUID = _uuid("event_id")
_EVENT_MESSAGES = f"""messages AS (
  SELECT event_id, event_id % 10 AS shape, CASE event_id % 10
    WHEN 0 THEN '{{"id":"' || {_EVENT_UUID} || '","gender":"' || event_type ||
      '","post_code":' || CAST(event_id AS VARCHAR) || ',"extra":' || props || '}}'
    WHEN 1 THEN '{{"id":"' || {_EVENT_UUID} || '","post_code":' || props || ',"dob":null}}'
    WHEN 2 THEN '{{"id":"' || {_EVENT_UUID} || '"}}'
    WHEN 3 THEN '{{"id":"ABCDEF' || substr({_EVENT_UUID}, 7) || '","gender":""}}'
    WHEN 4 THEN '{{"id":"' || event_type || '","gender":"' || event_type || '"}}'
    WHEN 5 THEN '{{"id":null,"ID":"' || {_EVENT_UUID} || '"}}'
    WHEN 6 THEN event_type
    WHEN 7 THEN '{{"id":"' || {_EVENT_UUID} || '",'
    WHEN 8 THEN '[{{"id":"' || {_EVENT_UUID} || '"}}]'
    WHEN 9 THEN CASE WHEN event_id % 20 = 9 THEN '' END END AS text
  FROM events),
objects AS (
  SELECT event_id, text,
    CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT' THEN text END AS object
  FROM messages),
decoded AS (
  SELECT event_id, text, object,
    json_extract_string(object, '$.id') AS id,
    json_extract_string(object, '$.gender') AS gender,
    json_extract_string(object, '$.post_code') AS post_code,
    json_extract_string(object, '$.dob') AS dob
  FROM objects),
judged AS (
  SELECT *, CASE
    WHEN text IS NULL OR text = '' THEN 'empty message'
    WHEN object IS NULL THEN 'malformed message'
    WHEN id IS NULL THEN 'no id'
    WHEN NOT regexp_full_match(id, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')
      THEN 'id is not a UUID' END AS reason
  FROM decoded)"""

# The odd texts as text, for judging them by what they say and not by how they were made.
_EVENT_DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"
_EVENT_PROFILES = f"""variants AS (
  SELECT {_uuid('event_id')} AS id,
    CASE event_id % 6
      WHEN 0 THEN '1 A St, City, State ' || event_type || ', Country' || chr(9)
      WHEN 1 THEN '2 B St, City,' || chr(160) || event_type || ' ,' || chr(8195) || 'Land' || chr(160)
      WHEN 2 THEN 'nocomma' WHEN 3 THEN '' WHEN 5 THEN 'a,' || event_type || ',' END AS address,
    CASE event_id % 8
      WHEN 0 THEN {_EVENT_DAY} || 'T04:05:06.789Z' WHEN 1 THEN {_EVENT_DAY} || 't4:5:6.7z'
      WHEN 2 THEN {_EVENT_DAY} || 'T04:05:06Z' WHEN 3 THEN {_EVENT_DAY} || 'T04:05:06.1234567Z'
      WHEN 4 THEN {_EVENT_DAY} || 'T04:05:06.789+00:00'
      WHEN 5 THEN ' ' || {_EVENT_DAY} || 'T04:05:06.789Z'
      WHEN 6 THEN '2023-02-29T04:05:06.789Z' END AS dob
  FROM events)"""

# Year, month and day of a date that has the one layout, as far as such a day exists.
_LAYOUT = (
    "([0-9]{4})-([0-9]{1,2})-([0-9]{1,2}| [0-9])[Tt](2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]"
    "[.][0-9]{1,6}[Zz]"
)
_DOB_DAY = (
    f"CASE WHEN regexp_full_match(dob, '{_LAYOUT}') AND dob NOT LIKE '0000%' THEN "
    "CAST(TRY_CAST(split_part(replace(upper(dob), ' ', ''), 'T', 1) AS DATE) AS VARCHAR) END"
)
# Whitespace of every kind, off both ends.
_BLANKS = "chr(9) || chr(10) || chr(13) || chr(32) || chr(160) || chr(8195)"


def _address_part(position: int) -> str:
    parts = "string_split(address, ',')"
    return f"CASE WHEN len({parts}) >= {-position} THEN trim({parts}[{position}], {_BLANKS}) END"


_REJECTS = f"""SELECT * FROM (SELECT id, concat_ws('; ',
    CASE WHEN dob IS NULL THEN 'no dob' WHEN {_DOB_DAY} IS NULL THEN 'dob is not a date' END,
    CASE WHEN address IS NULL THEN 'no address'
      WHEN NOT contains(address, ',') THEN 'address has no comma' END
  ) AS reason FROM variants) WHERE reason <> ''"""

# --- operators -------------------------------------------------------------------------------


def _age(as_of: str) -> str:
    """Whole years at a date, by comparing (month, day)."""
    born, today = "CAST(substr(dob, 1, 10) AS DATE)", f"DATE '{as_of}'"
    return (
        f"CAST(year({today}) - year({born}) - CASE WHEN month({today}) * 100 + day({today}) "
        f"< month({born}) * 100 + day({born}) THEN 1 ELSE 0 END AS INTEGER)"
    )


def _age_group(age: str) -> str:
    return f"""CASE WHEN {age} > 0 AND {age} <= 16 THEN '0-15'
      WHEN {age} > 16 AND {age} <= 31 THEN '16-30' WHEN {age} > 31 AND {age} <= 46 THEN '31-45'
      WHEN {age} > 46 AND {age} <= 60 THEN '46-60'
      WHEN {age} > 60 AND {age} <= 150 THEN '60+' END"""


def _part(position: int) -> str:
    return f"trim(split_part(address, ',', {position}))"


_CATEGORY = {"gender": "gender", "city": _part(-2), "country": _part(-1)}


def _share(dimension: str, as_of: str, source: str = "users") -> str:
    """One dimension's rows; age lists all its groups, the others those that occur."""
    if dimension == "age":
        return f"""SELECT label AS category, CAST(count(age_group) AS DOUBLE)
            / nullif(sum(count(age_group)) OVER (), 0) * 100 AS percentage,
            'age' AS dimension, '{as_of}' AS analysis_date
          FROM (VALUES ('0-15'), ('16-30'), ('31-45'), ('46-60'), ('60+')) AS labels(label)
          LEFT JOIN (SELECT {_age_group('age')} AS age_group
                     FROM (SELECT {_age(as_of)} AS age FROM {source})) ON label = age_group
          GROUP BY label"""
    category = _CATEGORY[dimension]
    return f"""SELECT {category} AS category,
        CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS percentage,
        '{dimension}' AS dimension, '{as_of}' AS analysis_date
      FROM {source} WHERE {category} IS NOT NULL GROUP BY {category}"""


def _day(as_of: str, source: str = "users") -> str:
    parts = [_share(d, as_of, source) for d in ("age", "gender", "city", "country")]
    return " UNION ALL ".join(f"SELECT * FROM ({part})" for part in parts)


def _chart(column: str, texts: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{d}' THEN '{text}'" for d, text in texts.items())
    return f"CASE dimension {whens} END AS {column}"


_TITLE = _chart(
    "title",
    {
        "age": "Percentage Distribution by Age Group on ",
        "gender": "Percentage Distribution by Gender on ",
        "country": "Percentage Distribution by Country on ",
    },
).replace(" END AS title", " END || analysis_date AS title")
_X_LABEL = _chart("x_label", {"age": "Age Group", "gender": "Gender", "country": "Country"})
_FILE = _chart(
    "file_name",
    {
        "age": "age_distribution.png",
        "gender": "gender_distribution.png",
        "country": "country_distribution.png",
    },
)
_LABEL = "CAST(CAST(round_even(percentage, 0) AS BIGINT) AS VARCHAR) || '%' AS label"
_MANY = "count(*) OVER (PARTITION BY dimension, analysis_date) > 20"

_USERNAME_HASH = "md5('{\"c0\":\"user' || CAST(c_custkey AS VARCHAR) || '\"}')"
_HASHED_ID = (
    f"substr({_USERNAME_HASH}, 1, 8) || '-' || substr({_USERNAME_HASH}, 9, 4) || '-8' || "
    f"substr({_USERNAME_HASH}, 14, 3) || '-8' || substr({_USERNAME_HASH}, 18, 3) || '-' || "
    f"substr({_USERNAME_HASH}, 21, 12)"
)
_STATE = "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE r_name END"
_FLATTENED = f"""SELECT {_HASHED_ID} AS id, c_mktsegment AS first_name, c_name AS last_name,
    {_GENDER} AS gender,
    {_STREET} || ', ' || {_CITY} || ', ' || {_STATE} || ', ' || n_name AS address,
    CAST(10000 + c_custkey % 90000 AS VARCHAR) AS post_code, {_REST} FROM {_PEOPLE}"""

_STORED_DAYS = f"results AS ({_day(AS_OF)} UNION ALL {_day(NEXT_DAY)})"

ORACLE: dict[str, str] = {
    "scan_users": f"WITH {_USERS} SELECT * FROM users",
    "flatten_profiles": _FLATTENED,
    "raw_profiles": f"SELECT * FROM ({_FLATTENED}) WHERE address IS NOT NULL",
    "raw_profiles_first": f"SELECT id, email FROM ({_FLATTENED})",
    "random_ids": """SELECT count(*) AS ids, count(*) AS different, true AS all_uuids
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "split_profiles": f"SELECT id, address IS NOT NULL AS whole FROM ({_FLATTENED})",
    "parse_dob": f"""WITH {_USERS}
      SELECT id, CAST(CAST(substr(dob, 1, 10) AS DATE) AS VARCHAR) AS born FROM users""",
    "parse_dob_variants": f"""WITH {_EVENT_PROFILES}
      SELECT id, {_DOB_DAY} AS born FROM variants""",
    "age_years": f"WITH {_USERS} SELECT id, {_age(AS_OF)} AS age FROM users",
    "age_group": f"""WITH {_USERS} SELECT id, {_age_group('age')} AS age_group
      FROM (SELECT id, {_age(AS_OF)} AS age FROM users)""",
    "address_country": f"WITH {_USERS} SELECT id, {_part(-1)} AS country FROM users",
    "address_city": f"WITH {_USERS} SELECT id, {_part(-2)} AS city FROM users",
    "address_variants": f"""WITH {_EVENT_PROFILES}
      SELECT id, {_address_part(-1)} AS country, {_address_part(-2)} AS city FROM variants""",
    "analysis_rejects": f"WITH {_EVENT_PROFILES} {_REJECTS}",
    "share": """SELECT event_type AS category,
        CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100 AS percentage
      FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
    "share_declared": """SELECT label AS category,
        CAST(count(event_type) AS DOUBLE) / sum(count(event_type)) OVER () * 100 AS percentage
      FROM (VALUES ('signup'), ('click'), ('view'), ('purchase'), ('refund')) AS labels(label)
      LEFT JOIN events ON event_type = label GROUP BY label""",
    "gender_distribution": f"WITH {_USERS} {_share('gender', AS_OF)}",
    "age_distribution": f"WITH {_USERS} {_share('age', AS_OF)}",
    "age_distribution_zero_fill": f"WITH {_USERS} {_share('age', '2100-06-30')}",
    "country_distribution": f"WITH {_USERS} {_share('country', AS_OF)}",
    "city_distribution": f"WITH {_USERS} {_share('city', AS_OF)}",
    "daily_distributions": f"WITH {_USERS} {_day(AS_OF)}",
    "daily_reject_counts": f"""WITH {_EVENT_PROFILES}, reasons AS (
        SELECT unnest(string_split(reason, '; ')) AS reason FROM ({_REJECTS}))
      SELECT label AS reason, count(reason) AS n
      FROM (VALUES ('no dob'), ('dob is not a date'), ('no address'), ('address has no comma'))
        AS labels(label) LEFT JOIN reasons ON label = reason GROUP BY label""",
    "daily_from_changes": f"WITH {_LATEST} {_day(NEXT_DAY, 'latest')}",
    "encode_roundtrip": f"WITH {_FULL_USERS} SELECT {_FIELDS} FROM full_users",
    "decode_users": f"""WITH {_EVENT_MESSAGES}
      SELECT event_id, id, gender, post_code, dob FROM decoded""",
    "classify_users": f"""WITH {_EVENT_MESSAGES}
      SELECT event_id, CASE WHEN reason IS NULL THEN lower(id) ELSE id END AS id,
        gender, post_code, CASE WHEN reason IS NOT NULL THEN text END AS raw, reason
      FROM judged""",
    "split_valid": f"""WITH {_EVENT_MESSAGES}
      SELECT event_id, CASE WHEN reason IS NULL THEN lower(id) END AS id, reason FROM judged""",
    "latest_by_key": """SELECT user_id, CAST(ts AS VARCHAR) AS ts, event_id, event_type, value
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
            AS nth FROM events) WHERE nth = 1""",
    "stream_decode_users": f"""WITH {_FULL_USERS}
      SELECT {_FIELDS}, CAST(NULL AS VARCHAR) AS reason FROM full_users""",
    "stream_upsert_users": f"WITH {_LATEST} SELECT * FROM latest",
    "stream_refused": f"""WITH {_EVENT_MESSAGES}
      SELECT event_id AS seq, text AS raw, reason FROM judged WHERE reason IS NOT NULL""",
    "log_after_restart": f"""WITH {_EVENT_MESSAGES}
      SELECT reason, count(*) AS n, count(DISTINCT event_id) AS messages FROM judged GROUP BY reason""",
    "ingest_progress": f"""WITH {_EVENT_MESSAGES}
      SELECT true AS several_batches, CAST(count(*) AS BIGINT) AS read,
        count(*) FILTER (reason IS NULL) AS accepted, count(reason) AS refused, 0 AS lost
      FROM judged""",
    "produce_and_ingest": f"SELECT * FROM ({_FLATTENED}) WHERE address IS NOT NULL",
    "produce_repeated_profile": f"""SELECT * REPLACE ('second-' || phone AS phone)
      FROM ({_FLATTENED}) WHERE address IS NOT NULL""",
    "compact_users": f"""WITH {_UPDATES}
      SELECT {_FIELDS} FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS nth FROM updates)
      WHERE nth = 1""",
    "users_by_id": f"""WITH {_FULL_USERS}, richest AS (
        SELECT {_uuid('c_custkey')} AS id FROM customer
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) = 1)
      SELECT {_FIELDS} FROM full_users JOIN richest USING (id)""",
    "created_users_current": f"WITH {_LATEST} SELECT * FROM latest",
    "upsert_results": f"WITH {_USERS}, {_STORED_DAYS} SELECT * FROM results",
    "upsert_results_merge": f"""WITH {_USERS}, {_UPDATES},
      old AS ({_share('city', AS_OF)}), new AS ({_day(AS_OF, 'updates')})
      SELECT * FROM new UNION ALL
      SELECT * FROM old WHERE category NOT IN (SELECT category FROM new WHERE dimension = 'city')
      """,
    "upsert_results_emptied": f"""WITH {_USERS}, results AS ({_day(AS_OF)})
      SELECT kind, dimension, category
      FROM results CROSS JOIN (VALUES ('results'), ('charts')) AS kinds(kind)
      WHERE dimension <> 'gender' AND (kind = 'results' OR dimension <> 'city')""",
    "views_over_existing_results": f"""WITH {_USERS}, {_STORED_DAYS}
      SELECT category AS country, percentage, analysis_date
      FROM results WHERE dimension = 'country'""",
    "profile_rejects": f"""SELECT reason, count(*) AS n FROM (
        SELECT CASE WHEN c_custkey % 10 = 6 THEN 'no profile' WHEN reason = '' THEN 'published'
          ELSE reason END AS reason
        FROM (SELECT c_custkey, concat_ws('; ',
            CASE WHEN c_custkey % 10 = 3 THEN 'no id' END,
            CASE WHEN {_STATE} IS NULL THEN 'no address' END,
            CASE WHEN c_custkey % 10 = 3 THEN 'no login.username' END,
            CASE WHEN c_custkey % 10 = 4 THEN 'no dob.date' END,
            CASE WHEN c_custkey % 10 = 5 THEN 'no phone' END) AS reason FROM {_PEOPLE}))
      GROUP BY reason""",
    "chart_arrays_long": f"""WITH {_USERS}, results AS ({_day(AS_OF)})
      SELECT dimension, analysis_date, row_number() OVER (PARTITION BY dimension, analysis_date
          ORDER BY percentage DESC) - 1 AS position, percentage
      FROM results""",
    "results_for_date": f"""WITH {_USERS}
      SELECT category, percentage FROM ({_share('country', NEXT_DAY)})""",
    "chart_series": f"""WITH {_USERS}, results AS ({_day(AS_OF)})
      SELECT dimension, analysis_date,
        rank() OVER (PARTITION BY dimension, analysis_date ORDER BY percentage DESC) AS rank,
        category, percentage, {_LABEL}, {_TITLE}, {_X_LABEL}, 'Percentage' AS y_label,
        CASE WHEN {_MANY} THEN 90 ELSE 0 END AS rotation,
        CAST(CASE WHEN {_MANY} THEN 0.3 ELSE 0.15 END AS DOUBLE) AS bottom_margin,
        count(*) OVER (PARTITION BY dimension, analysis_date) AS n_categories, {_FILE}
      FROM results WHERE dimension <> 'city'""",
    "chart_arrays": f"""WITH {_USERS}, results AS ({_day(AS_OF)})
      SELECT dimension, analysis_date, 0 AS chunk,
        CAST(row_number() OVER (PARTITION BY dimension, analysis_date
          ORDER BY percentage DESC, category) - 1 AS INTEGER) AS position,
        category, percentage
      FROM results""",
    "chart_places": f"""WITH {_USERS}, results AS ({_day(AS_OF)})
      SELECT dimension, analysis_date, row_number() OVER (PARTITION BY dimension, analysis_date
          ORDER BY percentage DESC, category) - 1 AS place, category, percentage
      FROM results""",
    "event_places": """SELECT event_type, event_id,
        row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS place FROM events""",
    "chart_dataset": f"""WITH {_USERS}, {_STORED_DAYS}
      SELECT analysis_date, dimension, {_FILE}, category, {_LABEL}
      FROM results WHERE dimension <> 'city'""",
    "republished_day": f"""WITH {_USERS}, {_UPDATES}
      SELECT dimension, category, percentage, 0 AS version FROM ({_day(AS_OF)})
      UNION ALL SELECT dimension, category, percentage, 1 FROM ({_day(AS_OF, 'updates')})""",
    "run_daily": f"WITH {_LATEST} {_day(AS_OF, 'latest')}",
    "tables_and_views": f"""WITH {_LATEST}
      SELECT dimension AS source, category AS name, percentage FROM ({_day(AS_OF, 'latest')})
      UNION ALL SELECT 'created_users', max(last_name), CAST(count(*) AS DOUBLE) FROM latest""",
}
