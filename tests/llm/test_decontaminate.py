import random
import re

import pytest
from pyspark.sql import functions as F

from rollcall.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w, k):
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def brute(docs, items):
    """Pairs with a window, anywhere, that holds 80 percent of the item's weight."""
    out = set()
    for i, text in docs:
        w = words(text)
        for j, item in items:
            own = words(item)
            if not own:
                continue
            k = min(5, len(own))
            want = shingles(own, k)
            total = sum(map(len, want))
            for s in range(max(1, len(w) - len(own) + 1)):
                held = want & shingles(w[s : s + len(own)], k) if len(w) >= k else set()
                if 100 * sum(map(len, held)) >= 80 * total:
                    out.add((i, j))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "lmnrst"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([3, 1, 8, 20, 30, 30, 45, 60, 300])]
    docs = []
    for i, (_, item) in enumerate(items):
        docs.append((10 * i, text(40) + item + text(40)))
        docs.append((10 * i + 1, [w.upper() + "," for w in item]))
        changed = list(item)
        changed[len(item) // 2] = "changed"
        docs.append((10 * i + 2, text(15) + changed + text(5)))
        docs.append((10 * i + 3, text(10) + item[: len(item) * 9 // 10] + text(30)))
        docs.append((10 * i + 4, text(10) + item[: len(item) // 2] + text(30)))
    docs += [(900 + i, text(50)) for i in range(20)]
    join = lambda rows: [(i, " ".join(w)) for i, w in rows]
    return join(docs), [*join(items), (90, None), (91, ""), (None, items[4][1] and " ".join(items[4][1]))]


def test_brute_force(spark, tables):
    docs, items = tables
    df = spark.createDataFrame([*docs, (None, docs[20][1]), (5, None), (6, "")], "doc_id long, text string")
    got = d.find_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    want = brute([*docs, (None, docs[20][1])], items)
    assert found <= want
    assert found == want, (len(found), len(want))


def test_rows_of_clean_documents_stay(spark, odd_docs, tables):
    items = spark.createDataFrame([(1, "seven wise owls look on from the old oak")], "item_id long, text string")
    left = d.without_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["2", "3", "4", "5", "5", "None", "7", "8", "10"])


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert d.find_contaminated(odd_docs, items).count() == 0
    assert d.find_contaminated(no_docs, items).count() == 0


def test_no_near_fingerprint_is_missed(spark):
    """Any ``RADIUS`` bits turned: the row is among those that meet in a block."""
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        a = rng.getrandbits(63)
        b = a
        for bit in rng.sample(range(63), d.RADIUS):
            b ^= 1 << bit
        rows.append((len(rows) % 7, len(rows), a, b))
    df = spark.createDataFrame(rows, "key long, item long, print long, item_print long")
    near = d.within_radius(df.select("key", "item", "print"), df.select("item", "item_print")).collect()
    assert len(near) == 300 and {r.hamming for r in near} == {d.RADIUS}
    far = df.withColumn("item_print", F.col("print").bitwiseXOR(F.lit((1 << d.RADIUS + 1) - 1)))
    assert d.within_radius(far.select("key", "item", "print"), far.select("item", "item_print")).count() == 0


def test_counters_do_not_overflow(spark):
    """The same word 255 times, and 1000 in wider lanes, gives the word's own hash."""
    for n in (1, 255, 1000):
        width = d.lane_width(n)
        mask = (1 << width * (63 // width)) - 1
        row = spark.range(1).select(
            d.simhash(F.array_repeat(F.lit("word"), n), width).alias("p"), F.xxhash64(F.lit("word")).alias("h")
        ).first()
        assert row.p == row.h & mask


def test_cut_and_rewritten_items_are_all_found(spark):
    """Windows that hold 80 to 90 percent of an item between other text: full agreement with brute force."""
    rng = random.Random(12)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "lmnrst"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items, docs = [], []
    for n, cuts in ((20, (2, 3)), (50, (5, 8)), (100, (10, 15)), (200, (20, 36))):
        for _ in range(4):
            item = text(n)
            items.append((len(items), " ".join(item)))
            for cut in cuts:
                docs.append((len(docs), " ".join(text(30) + item[:-cut] + text(40))))
                docs.append((len(docs), " ".join(text(30) + item[cut:] + text(3))))
    got = d.find_contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want, found = brute(docs, items), {(r.doc_id, r.item_id) for r in got.collect()}
    assert len(want) > 40 and found == want, (len(found & want), len(want))


def test_nested_and_overlapping_items(spark):
    """Items that lie inside one another, or share words, are each found where a document holds them."""
    rng = random.Random(13)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "lmnrst"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = text(120)
    items = [passage, passage[40:60], passage[50:90], passage[:30], passage[100:], passage[70:] + text(5), text(9)]
    docs = [text(20) + passage + text(20), passage, text(3) + passage[30:95], passage[45:] + text(10), passage + passage]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    items = [(i, " ".join(w)) for i, w in enumerate(items)]
    got = d.find_contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want, found = brute(docs, items), {(r.doc_id, r.item_id) for r in got.collect()}
    assert len(want) > 15 and found == want, (len(found & want), len(want))


def test_very_long_items(spark):
    """An item of 3,000 words in 50 documents, whole, cut, and where it is said twice; periodic text, too."""
    rng = random.Random(14)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    item, beat = text(3000), "one two three four five six seven".split() * 100
    docs = [text(20) + item[: 3000 - 10 * i] + text(20) for i in range(50)]
    docs += [item + text(5) + item, beat * 3, text(3000)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(beat))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.find_contaminated(df, items).collect()}
    assert set(got) == {*((i, 1) for i in range(51)), (51, 2)}
    assert all(got[i, 1].start == min(20, max(0, 40 - 10 * i)) for i in range(50)) and got[50, 1].start == 0
    assert got[50, 1].hamming == 0 and got[51, 2].hamming == 0


def test_weight_decides_whatever_the_words(spark):
    """Items that repeat a word, or mix long and short ones, between heavy text: by weight alone, as by brute force.

    Such windows share few of the item's words by number, though most of its weight.
    """
    rng = random.Random(15)
    word = lambda n: "".join(rng.choice("bcdfgklm") + rng.choice("aeiou") for _ in range(n))
    text = lambda count, n: [word(n) for _ in range(count)]
    items, docs = [], []
    for _ in range(6):
        told = text(40, 3)
        refrain, mixed = told + ["la"] * 100, text(34, 12)
        items += [refrain, mixed + text(40, 1), refrain[::-1], text(5, 1) + told]
        docs += [text(30, 3) + told + text(120, 3), text(90, 10) + mixed + text(60, 10), text(130, 8) + told[::-1] + text(4, 8)]
        docs += [text(20, 20) + told[:35] + text(20, 20), text(9, 9) + refrain[5:] + text(9, 9), text(60, 3)]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    items = [(i, " ".join(w)) for i, w in enumerate(items)]
    got = d.find_contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want, rows = brute(docs, items), got.collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert len(want) >= 30 and found == want, (len(found & want), len(want))
    assert len(rows) == len(found) and all(0.8 <= r.similarity <= 1 for r in rows)


def test_every_window_is_fingerprinted(spark):
    """Fingerprints of all windows that hold enough are those of the shingles that window and item share."""
    rng = random.Random(16)
    item = [f"w{rng.randrange(10**rng.randrange(2, 9))}" for _ in range(40)]
    texts = [item[:6] + item + item[20:] + item, [f"x{i}" for i in range(9)] + item[3:] + item[:9], item[10:] + item[:35]]
    want = []
    for n, w in enumerate(texts):
        for s in range(max(1, len(w) - 40 + 1)):
            both = sorted(shingles(w[s : s + 40], 5) & shingles(item, 5))
            if 100 * sum(map(len, both)) >= 80 * sum(map(len, shingles(item, 5))):
                want.append((n, [x for x in both for _ in range(max(1, round(len(x) ** 0.5)))]))
    width = d.lane_width(1000)
    rows = spark.createDataFrame(want, "key int, voiced array<string>").select("key", d.simhash(F.col("voiced"), width).alias("p")).collect()
    items = d.benchmark_items(spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).withColumn("item", F.lit(0))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "key long, text string")
    own = d.item_shingles(items, [5])
    hits = d.shared_positions(docs, own, [5]).join(own, ["k", "hash"]).join(items.select("item", "weight"), "item")
    sized = hits.join(docs.select("key", F.size(d.words_of(F.col("text"))).alias("size")), "key")
    got = d.printed_windows(sized, width).collect()
    assert {(r.key, r.print) for r in got} == {(r.key, r.p) for r in rows} and len(got) > 20
