import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.llm import trie as m

COLUMNS = "conv_id long, turn long, role string, text string, seq string, depth int"


def rebuilt(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    own = {c: [(x[2], x[3]) for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    return out


def plain_trie(turns):
    """All nodes by walking every prefix of every conversation."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, t in turns.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].add(c)
        ends[tuple(t)].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * words
    return sorted(
        (
            min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, own in members.items()
    )


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def random_rows(seed, n=60):
    """Conversations over few texts: many share turns, some are copies, some are long."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 40 if c % 17 == 0 else 4])):
            rows.append((c, t, rng.choice(["user", None, ""]), rng.choice(["a b", "a b", "c", None, " "]), "x", 1))
    return rows


@pytest.mark.parametrize("partitions", [None, 2, 7, 40])
def test_against_all_prefixes(spark, partitions):
    rows = random_rows(partitions or 0)
    df = spark.createDataFrame(rows, COLUMNS)
    sequences = m.branched_turns(df)
    want = plain_trie(rebuilt(rows))
    assert found(m.prefix_trie(sequences, partitions)) == want


@pytest.mark.parametrize("seed", range(4))
def test_deep_common_prefixes_over_borders(spark, seed):
    """A stem that all share, branches that part at all depths, in many partitions."""
    rng = random.Random(seed)
    stem = [f"s{i}" for i in range(30)]
    turns = {}
    for c in range(80):
        cut = rng.randint(0, 30)
        turns[c] = [("u", x) for x in stem[:cut] + [rng.choice("pq") for _ in range(rng.randint(0, 3))]]
    rows = [(c, i, r, x, "y", 2) for c, t in turns.items() for i, (r, x) in enumerate(t)]
    df = spark.createDataFrame(rows, COLUMNS)
    plain = m.branched_turns(df, 1, F.lit(0))
    got = found(m.prefix_trie(plain, 25))
    assert got == plain_trie({c: t for c, t in turns.items() if t})


def test_corpus(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    sequences = m.branched_turns(df)
    assert found(m.prefix_trie(sequences, 9)) == plain_trie(rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost", "s", 1), (5, None, None, "late", "s", 1), (5, None, None, "late", "s", 1),
        (5, 0, "user", None, "s", 1), (5, 0, "assistant", "tie", "s", None), (0, 3, "user", "x " * 60_000, "s", 1),
        (-7, 0, "user", "ü 你好", "s", 1), (25, None, None, None, "s", 1), (20, 1, "", "", "s", 1),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    assert found(m.conversation_trie(df)) == plain_trie(rebuilt(rows))
    empty = spark.createDataFrame([], COLUMNS)
    assert m.conversation_trie(empty).count() == 0


def test_turnless(spark):
    """One conversation that has lost all its turns: a root that is a leaf."""
    c = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    df = spark.createDataFrame([(c, 0, "user", "gone", "s", 1)], COLUMNS)
    assert found(m.conversation_trie(df)) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_long_id_lists_are_packed(spark, monkeypatch):
    monkeypatch.setattr(m, "ID_BYTES", 50)
    ids = spark.range(1, 501).select(F.lit(b"k").alias("ends"), F.col("id").alias("conv_id"))
    want = hashlib.sha256(",".join(map(str, range(1, 501))).encode()).hexdigest()
    assert [tuple(r) for r in m.id_list_hashes(ids).collect()] == [(b"k", want)]
