import json

from pyspark.sql import functions as F

from checks import tables as t
from rollcall.operators import classify_users, decode_users, encode_users, split_valid
from rollcall.schema import USER_FIELDS

ID = "6f1c5a3e-8f0a-4d59-9a38-0a6b3f4e2d11"

# text -> (id, post_code, reason for refusal)
MESSAGES = {
    f'{{"id":"{ID}","post_code":12345,"dob":"d","extra":1}}': (ID, "12345", None),
    f'{{"id":"{ID}","post_code":"01234"}}': (ID, "01234", None),
    f'{{"id":"{ID}","post_code":{{"x":[1,2]}},"dob":null}}': (ID, '{"x":[1,2]}', None),
    f'{{"id":"{ID}","post_code":1234.50}}': (ID, "1234.5", None),
    f'{{"id":"h","id":"{ID}"}}': (ID, None, None),
    f'{{"id":"{ID}"}} trailing': (ID, None, None),
    '{"id":"a"}': ("a", None, "id is not a UUID"),
    '{"id":5}': ("5", None, "id is not a UUID"),
    f'{{"ID":"{ID}"}}': (None, None, "no id"),
    '{"id":null,"post_code":"1"}': (None, "1", "no id"),
    "{}": (None, None, "no id"),
    "garbage": (None, None, "malformed message"),
    '{"id":"e",': (None, None, "malformed message"),
    f'[{{"id":"{ID}"}}]': (None, None, "malformed message"),
    "[]": (None, None, "malformed message"),
    "null": (None, None, "malformed message"),
    "12": (None, None, "malformed message"),
    "": (None, None, "empty message"),
    "  ": (None, None, "empty message"),
    None: (None, None, "empty message"),
}


def frame(spark, texts):
    rows = [(i, None if s is None else bytearray(s.encode())) for i, s in enumerate(texts)]
    return spark.createDataFrame(rows, "n int, value binary")


def test_decode(spark):
    decoded = decode_users(frame(spark, MESSAGES), ["n"])
    assert decoded.columns == ["n", *USER_FIELDS]
    found = [(r.id, r.post_code) for r in decoded.orderBy("n").collect()]
    assert found == [expected[:2] for expected in MESSAGES.values()]


def test_refusals(spark):
    rows = classify_users(frame(spark, MESSAGES), ["n"]).orderBy("n").collect()
    assert [r.reason for r in rows] == [expected[2] for expected in MESSAGES.values()]
    for row, text in zip(rows, MESSAGES):
        assert row.raw == (text if row.reason else None)


def test_bytes_that_are_no_text(spark):
    rows = [(bytearray(b"\xff\xfe"),), (bytearray(b'{"id":"\xff"}'),)]
    messages = spark.createDataFrame(rows, "value binary")
    reasons = [r.reason for r in classify_users(messages).collect()]
    assert reasons[0] == "malformed message" and reasons[1] is not None


def test_split_loses_nothing(spark):
    valid, refused = split_valid(frame(spark, MESSAGES), ["n"])
    accepted = [r.n for r in valid.collect()]
    turned_away = [r.n for r in refused.collect()]
    assert sorted(accepted + turned_away) == list(range(len(MESSAGES)))
    assert valid.columns == ["n", *USER_FIELDS]
    assert refused.columns == ["n", "raw", "reason"]


def test_ids_are_keys_not_spellings(spark):
    valid, _ = split_valid(frame(spark, [f'{{"id":"{ID.upper()}"}}']))
    assert valid.first().id == ID


def test_a_filter_does_not_parse_again(spark, executed):
    plan = executed(split_valid(frame(spark, MESSAGES), ["n"])[0])
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan


def test_encode_is_plain_json_with_nulls(spark, sf_dir):
    users = t.full_users(spark, sf_dir)
    values = [json.loads(bytes(r.value)) for r in encode_users(users, ["seq"]).collect()]
    assert all(list(v) == list(USER_FIELDS) for v in values)
    assert any(v["gender"] is None for v in values)


def test_awkward_text_survives_the_round_trip(spark):
    rows = [tuple(f"{c}\"\\\n\t,é漢 😀{i}" for c in USER_FIELDS) for i in range(3)]
    rows.append(tuple(None if i % 2 else "" for i, _ in enumerate(USER_FIELDS)))
    users = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in USER_FIELDS))
    assert sorted(map(str, decode_users(encode_users(users)).collect())) == sorted(
        map(str, users.collect())
    )


def test_other_schema(spark):
    events = t.table(spark, "/root/testdata/sf0.001", "events")
    schema = "k int"
    from pyspark.sql.types import StructType

    messages = events.select("event_id", F.col("props").cast("binary").alias("value"))
    decoded = decode_users(messages, ["event_id"], StructType.fromDDL(schema))
    assert decoded.where("k is null").count() == 0
