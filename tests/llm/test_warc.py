import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rollcall.llm import warc as w


def run(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, size int, digest string")
    archives = w.write_warc(pages, f"{tmp_path}/warc")
    return archives, w.read_warc(spark, archives)


def test_round_trip(spark, tmp_path):
    """Nulls, empty and very long payloads, repeated rows, copies, odd addresses."""
    rng = random.Random(1)
    long = "".join(rng.choice("abcdé🙂\r\n") for _ in range(400_000))
    copy = "x" * 1000
    rows = [
        (1, "http://a/", copy), (2, "http://b/", copy), (9, "http://c/", copy), (9, "http://c/", copy),
        (3, None, None), (4, "http://d/ \r\nWARC-Type: evil", ""), (5, "u", "short"), (6, "u", "short"),
        (7, "u", long), (None, "u", copy), (None, None, "y" * 2000), (None, None, "y" * 2000), (8, "u", "é" * 500),
    ]
    archives, read = run(spark, [(*r, 0, "z") for r in rows], tmp_path)
    got = read.collect()
    assert all(r.error is None and r.digest_ok is not False for r in got)

    def expected(page_id, html):
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        ids = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(data) >= 1000 and ids and page_id != max(ids)
        return (str(page_id), len(data), digest, "revisit" if again else "response", str(max(ids)) if again else "None")

    found = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got]
    assert sorted(found) == sorted(expected(i, h) for i, _, h in rows)
    payloads = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id is not None}
    assert payloads[7].decode() == long and payloads[3] == b"" == payloads[4]
    assert archives.agg(F.sum("records")).first()[0] == len(rows)


def test_empty_table(spark, tmp_path):
    archives, read = run(spark, [], tmp_path)
    assert archives.count() == 0 and read.count() == 0


@pytest.fixture
def archive(tmp_path):
    records = [w.record_bytes(i, "http://a/", b"payload %d" % i * 50, hashlib.sha1(b"payload %d" % i * 50).hexdigest(), None, "response") for i in range(5)]
    return tmp_path / "a.warc.gz", records


def read(spark, path):
    return w.read_warc(spark, spark.createDataFrame([(str(path),), (None,)], "path string")).collect()


def test_one_member_per_record(spark, archive):
    path, records = archive
    path.write_bytes(b"".join(gzip.compress(r) for r in records))
    rest, members = path.read_bytes(), 0
    while rest:
        box = zlib.decompressobj(31)
        assert box.decompress(rest).startswith(b"WARC/1.1")
        rest, members = box.unused_data, members + 1
    assert members == 5
    assert sorted(r.page_id for r in read(spark, path)) == list(range(5))


def test_plain_and_single_member_files(spark, archive):
    path, records = archive
    for data in (b"".join(records), gzip.compress(b"".join(records))):
        path.write_bytes(data)
        assert [r.digest_ok for r in read(spark, path)] == [True] * 5


def test_damage_is_reported(spark, archive):
    path, records = archive
    broken = records[3].replace(b"payload 3", b"payload X", 1)
    path.write_bytes(b"".join(gzip.compress(r) for r in (*records[:3], broken)) + gzip.compress(records[4])[:-20])
    got = read(spark, path)
    assert [r.digest_ok for r in got if r.error is None] == [True, True, True, False]
    assert [r.error for r in got if r.error] == ["the last member is cut off"]
    path.write_bytes(b"no archive at all\r\n\r\n")
    assert [r.error for r in read(spark, path)] == ["no record begins here"]
    assert read(spark, path.parent / "missing.gz")[0].error


def test_long_addresses(spark, tmp_path):
    """A head of several MiB is read like others, and all records of its archive after it."""
    rows = [(i, "data:text/html," + "ab3" * 700_000 if i in (1, 4) else "http://a/", f"payload {i}", 0, "z") for i in range(9)]
    archives, read = run(spark, rows, tmp_path)
    got = read.select("page_id", "error", F.length("url").alias("n")).collect()
    assert archives.agg(F.sum("records")).first()[0] == len(got) == 9
    assert all(r.error is None for r in got) and sorted(r.page_id for r in got) == list(range(9))
    assert {r.page_id for r in got if r.n > 2_000_000} == {1, 4}
