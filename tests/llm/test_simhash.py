import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from rollcall.llm import components
from rollcall.llm import simhash as m

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def plain_components(rows, radius=2):
    """doc_id -> smallest doc_id, by all pairs; rows of one id are one document."""
    rows = [(i, plain_print(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = plain_components(rows)
    got = m.simhash_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted(
        (str(i), f"{plain_print(t):016x}") for i, t in rows
    )
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    return want


def test_corpus_against_all_pairs(spark, corpus):
    want = check(corpus("0.01")[0])
    assert len(set(want.values())) < len(want)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert m.simhash_duplicates(no_docs).count() == 0


def test_spark_hashes_alike(spark):
    """The hash is the one that Spark's own function gives."""
    text = "one Two three"
    own = spark.range(1).select(F.xxhash64(F.lit(text.lower())).alias("h")).first().h
    assert m.fingerprint(text) == own % 2**64


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 83}" for i in range(1000))
    monkeypatch.setattr(m, "CHUNK", 7)
    assert m.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("parts", [1, 2, 4, 8, 16])
@pytest.mark.parametrize("tile", [3, 2048])
def test_near_pairs_of_every_tiling(spark, monkeypatch, parts, tile):
    """Chains of near fingerprints, a dense ball, the extremes; tiles of several pieces."""
    monkeypatch.setattr(m, "TILE", tile)
    rng = random.Random(parts)
    prints = {0, 2**64 - 1, 1, 3, 2**63, 2**64 - 2}
    ball = rng.getrandbits(64)
    prints |= {ball ^ (1 << i) for i in range(64)}
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(rng.randint(0, 4)):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.add(p)
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p, n) for n, p in enumerate(prints)]
    links = m.near_fingerprints(spark.createDataFrame(signed, "print long, node long"), 2, parts)
    got = {r.node: r.root for r in components.connected_components(links).collect()}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert {i: got.get(i, i) for i in range(len(prints))} == {i: find(i) for i in range(len(prints))}
