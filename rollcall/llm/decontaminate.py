"""Benchmark items inside documents: SimHash of item-sized windows, multi-index blocks, exact verification.

Documents' shingles of five words are held against those of all items, by hash. An item is
looked for in a text that has one of its telling shingles: a window without any of them cannot
hold ``PERCENT`` of the item's weight. Windows have as many words as the item. What each holds, and
its SimHash fingerprint (63 bits, 62 for very long items), come from running sums over the places of
the shared shingles, in time linear in their number: both change only there, so that one sum stands for
all windows up to the next change. Fingerprints of all windows that can hold enough meet the item's in
the blocks of a multi-index, which brings together all that differ in ``RADIUS`` bits or fewer; the best
of those is verified on whole shingles, which weigh as much as they have characters.

A fingerprint is voted by the item's distinct shingles, each with the root of its weight; other text has
no vote. So the fingerprints of an item and of a window with 80 percent of its weight are at a cosine of
the root of 0.8, whatever words there are and however often: 9 bits on average, 12 where all that is
missing is one shingle. ``RADIUS`` is 3.5 standard deviations above that. Everything here is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clusters import sent_if_small
from .common import written

SHINGLE = 5
#: Bits that the fingerprints of a window and its item may differ in.
RADIUS = 23
PERCENT = 80
#: Bits of the eight blocks of a fingerprint. Of 23 differing bits, one block has two at most: it agrees
#: when each side turns one bit.
BLOCKS = (8, 8, 8, 8, 8, 8, 8, 7)
BROADCAST_ITEM_ROWS = 500_000


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, even where lambdas use it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of letters, marks and digits, in lower case; none for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", -1)
    return F.filter(parts, lambda w: w != "")


def text_key(text: Column) -> Column:
    """The text's 128-bit digest; null is as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def shingle_hashes(words: Column, k: int) -> Column:
    """Hashes of the ``k`` words from each position on; null for fewer words."""

    def hashes(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - k),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]),
        )
        return F.when(F.size(w) >= k, each)

    return bound(words, hashes)


def shingle_texts(words: Column, k: Column) -> Column:
    """The distinct shingles of ``k`` words as text; a shorter text is one whole."""

    def texts(w: Column) -> Column:
        last = F.greatest(F.size(w) - k, F.lit(0))
        return F.array_distinct(
            F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.concat_ws(" ", F.slice(w, i, k)))
        )

    return bound(words, texts)


def total_weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, s: a + F.length(s))


def votes_of(weight: Column) -> Column:
    """The votes of a shingle: the root of its weight, so that a window's share of the item decides its distance."""
    return F.greatest(F.round(F.sqrt(weight)), F.lit(1)).cast("int")


def item_print(words: Column, k: Column, width: int) -> Column:
    """SimHash of an item, over its distinct shingles with their votes."""
    voiced = F.transform(shingle_texts(words, k), lambda s: F.array_repeat(s, votes_of(F.length(s))))
    return simhash(F.flatten(voiced), width)


def lane_width(most_words: int) -> int:
    """Bits of a counter that can count as many words, with one to spare."""
    return next(w for w in (9, 21, 31) if most_words < 1 << (w - 1))


def _judged(counted: list[Column], total: Column, width: int) -> Column:
    """A fingerprint: the bits that more than half of ``total`` votes are for. ``counted`` are the counters."""
    ones = _ones(width)
    bias = F.lit(ones) * ((1 << (width - 1)) - 1 - F.floor(total / 2))
    bits = F.lit(0).cast("long")
    for k, votes in enumerate(counted):
        won = F.shiftrightunsigned(votes + bias, width - 1).bitwiseAND(F.lit(ones))
        bits = bits.bitwiseOR(F.shiftleft(won, k))
    return bits


def simhash(words: Column, width: int) -> Column:
    """SimHash over words: counters side by side in a few longs, all bits judged at once."""

    def judged(hashes: Column) -> Column:
        picked = [F.transform(hashes, _lanes(k, _ones(width))) for k in range(width)]
        counted = [F.aggregate(p, F.lit(0).cast("long"), lambda a, v: a + v) for p in picked]
        return _judged(counted, F.size(hashes), width)

    return bound(F.transform(words, lambda w: F.xxhash64(w)), judged)


def _ones(width: int) -> int:
    return sum(1 << (width * j) for j in range(63 // width))


def _lanes(k: int, ones: int):
    return lambda h: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(ones))


def blocks_of(print_: Column) -> Column:
    """Array of (block, value) of a fingerprint, also with each single bit of a block turned."""
    parts, at = [], 0
    for number, bits in enumerate(BLOCKS):
        value = F.shiftrightunsigned(print_, at).bitwiseAND(F.lit((1 << bits) - 1))
        turns = [0, *(1 << b for b in range(bits))]
        parts += [
            F.struct(F.lit(number).alias("block"), value.bitwiseXOR(F.lit(t).cast("long")).alias("value"))
            for t in turns
        ]
        at += bits
    return F.array(*parts)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, n, k, weight) of the items that have words."""
    k = F.least(F.size("words"), F.lit(SHINGLE))
    return (
        benchmark.select("item_id", words_of(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
        .select("item_id", "words", F.size("words").alias("n"), k.alias("k"))
        .withColumn("weight", total_weight(shingle_texts(F.col("words"), F.col("k"))))
    )


def item_shingles(items: DataFrame, ks: list[int]) -> DataFrame:
    """(item, k, n, hash, offset, w, feature): the distinct shingles of every item, with place, weight and what votes."""
    found = None
    for k in ks:
        own = items.filter(F.col("k") == k)
        at = own.select("item", "k", "n", "words", F.posexplode(shingle_hashes(F.col("words"), k)).alias("offset", "hash"))
        text = F.concat_ws(" ", F.slice("words", F.col("offset") + 1, k))
        rows = at.select("item", "k", "n", "hash", "offset", F.length(text).alias("w"), F.xxhash64(text).alias("feature"))
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("item", "k", "n", "hash").agg(
        F.min("offset").alias("offset"), F.first("w").alias("w"), F.first("feature").alias("feature")
    )


def telling_shingles(shingles: DataFrame) -> DataFrame:
    """(hash, k, item): of each item the shingles that fewest items have, until more than the rest may be missing.

    A window without any of these holds less than ``PERCENT`` of the item.
    """
    items = Window.partitionBy("item")
    before = items.orderBy("f", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return (
        shingles.withColumn("f", F.count("*").over(Window.partitionBy("hash", "k")))
        .withColumn("total", F.sum("w").over(items))
        .withColumn("before", F.coalesce(F.sum("w").over(before), F.lit(0)))
        .filter(100 * F.col("before") <= (100 - PERCENT) * F.col("total"))
        .select("hash", "k", "item")
    )


def shared_positions(docs: DataFrame, shingles: DataFrame, ks: list[int]) -> DataFrame:
    """(key, k, pos, hash): per text the positions of shingles that some item has."""
    found = None
    for k in ks:
        known = shingles.filter(F.col("k") == k).select("hash").distinct()
        few = known.count() <= BROADCAST_ITEM_ROWS
        at = docs.select("key", F.posexplode(shingle_hashes(words_of(F.col("text")), k)).alias("pos", "hash"))
        met = at.join(F.broadcast(known) if few else known, "hash", "left_semi").select("key", F.lit(k).alias("k"), "pos", "hash")
        found = met if found is None else found.unionByName(met)
    return found


def printed_windows(hits: DataFrame, width: int) -> DataFrame:
    """(key, item, print, held, fits, start): the windows of each text and item that can hold ``PERCENT``.

    ``hits(key, item, size, n, k, weight, pos, hash, offset, w, feature)`` are the item's shingles in
    the text. A hit counts in the windows that begin up to ``n - k`` before it and behind the last place
    of the same shingle: an interval. What a window holds, and the votes for its fingerprint, are the
    sums of the intervals open at its start; a row stands for all windows up to the next. Of windows
    with one fingerprint, that which holds most is given; of equal ones, that where most shingles stand
    as far in as in the item, then the first.
    """
    last = F.greatest(F.col("size") - F.col("n"), F.lit(0))
    before = F.lag("pos").over(Window.partitionBy("key", "item", "hash").orderBy("pos"))
    opens = F.greatest(F.col("pos") + F.col("k") - F.col("n"), F.coalesce(before + 1, F.lit(0)), F.lit(0))
    aligned = F.least(F.greatest(F.col("pos") - F.col("offset"), F.lit(0)), last)
    change = lambda at, sign, fits: F.struct(
        at.alias("start"), F.lit(sign).cast("long").alias("sign"), F.lit(fits).cast("long").alias("fits")
    )
    placed = hits.withColumn("opens", opens).withColumn("last", last).withColumn("votes", votes_of(F.col("w")))
    changes = F.array(
        F.when(F.col("opens") <= F.col("last"), change(F.col("opens"), 1, 0)),
        F.when((F.col("opens") <= F.col("last")) & (F.col("pos") < F.col("last")), change(F.col("pos") + 1, -1, 0)),
        change(aligned, 0, 1),
    )
    lanes = [f"v{k}" for k in range(width)]
    voted = F.col("c.sign") * F.col("votes")
    at = (
        placed.select("key", "item", "weight", "w", "votes", "feature", F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("c"))
        .groupBy("key", "item", "weight", "c.start")
        .agg(
            F.sum(F.col("c.sign") * F.col("w")).alias("w"), F.sum("c.fits").alias("fits"), F.sum(voted).alias("votes"),
            *(F.sum(voted * _lanes(k, _ones(width))(F.col("feature"))).alias(v) for k, v in enumerate(lanes)),
        )
    )
    so_far = Window.partitionBy("key", "item").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    sums = at.select("key", "item", "weight", "start", "fits", *(F.sum(c).over(so_far).alias(c) for c in ("w", "votes", *lanes)))
    held = sums.filter(100 * F.col("w") >= PERCENT * F.col("weight"))
    prints = held.withColumn("print", _judged([F.col(v) for v in lanes], F.col("votes"), width))
    best = F.max(F.struct(F.col("w").alias("held"), "fits", (-F.col("start")).alias("back"))).alias("best")
    return prints.groupBy("key", "item", "print").agg(best).select(
        "key", "item", "print", "best.held", "best.fits", (-F.col("best.back")).alias("start")
    )


def within_radius(windows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of ``windows(key, item, print, ...)`` within ``RADIUS`` of the print of their item, with ``hamming``.

    ``index(item, item_print)``. Both sides' blocks meet, each with one bit turned: none within the
    radius is missed.
    """
    sides = [
        df.select(*own, F.explode(blocks_of(F.col(p))).alias("b")).select(*own, "b.*")
        for df, own, p in ((windows, ["key", "item", "print"], "print"), (index, ["item", "item_print"], "item_print"))
    ]
    met = sides[0].join(sides[1], ["item", "block", "value"])
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).alias("hamming")
    near = met.select("key", "item", "print", apart).filter(F.col("hamming") <= RADIUS).distinct()
    return windows.join(near, ["key", "item", "print"]).drop("print")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, similarity, start, n_words, hamming): the best window per text and item.

    ``key`` is ``text_key`` of a text of ``docs(text)``; copies of a text are judged once.
    ``similarity`` is the share of the item's weight. Texts and items without words match nothing;
    an empty benchmark gives no rows. Items need not differ; a null item_id is an id as others.
    Texts and items may have any length: the work is linear in what they share. Every window that can
    hold ``PERCENT`` of an item is fingerprinted.
    """
    items = benchmark_items(benchmark).withColumn("item", F.monotonically_increasing_id())
    items = written(items, "bench-items")
    ks = sorted(r.k for r in items.select("k").distinct().collect()) or [1]
    docs = docs.select(text_key(F.col("text")).alias("key"), "text")
    shingles = written(item_shingles(items, ks), "bench-shingles")
    few = shingles.count() <= BROADCAST_ITEM_ROWS
    most = shingles.groupBy("item").agg(F.sum(votes_of(F.col("w"))).alias("votes")).agg(F.max("votes")).first()[0]
    width = lane_width(most or 1)
    sent = lambda df: F.broadcast(df) if few else df
    hits = written(shared_positions(docs, shingles, ks).distinct(), "bench-hits")
    telling = written(telling_shingles(shingles), "bench-telling")
    pairs = written(hits.join(sent(telling), ["hash", "k"]).select("key", "item").distinct(), "bench-pairs")
    texts = docs.join(sent_if_small(pairs.select("key").distinct()), "key", "left_semi").dropDuplicates(["key"])
    texts = written(texts.select("key", words_of(F.col("text")).alias("words")), "bench-texts")
    matched = (
        hits.join(sent_if_small(pairs), "key").join(sent(shingles), ["item", "k", "hash"])
        .join(items.select("item", "weight"), "item")
        .join(texts.select("key", F.size("words").alias("size")), "key")
    )
    windows = written(printed_windows(matched, width), "bench-windows")
    index = items.select("item", item_print(F.col("words"), F.col("k"), width).alias("item_print"))
    index = index.join(sent_if_small(windows.select("item").distinct()), "item", "left_semi")
    near = within_radius(windows, written(index, "bench-index"))
    first = F.max(F.struct("held", "fits", (-F.col("start")).alias("back"), "hamming")).alias("f")
    near = near.groupBy("key", "item").agg(first).select("key", "item", (-F.col("f.back")).alias("start"), "f.hamming")
    sized = written(near, "bench-near").join(texts, "key").join(items.select("item", "n"), "item")
    found = sized.withColumn("words", F.slice("words", F.col("start") + 1, F.col("n")))
    own = items.select("item", "item_id", "k", "weight", F.col("words").alias("item_words"))
    found = found.join(own, "item")
    shared = total_weight(
        F.array_intersect(shingle_texts(F.col("words"), F.col("k")), shingle_texts(F.col("item_words"), F.col("k")))
    )
    verified = found.withColumn("shared", shared).filter(100 * F.col("shared") >= PERCENT * F.col("weight"))
    best = F.max(F.struct(F.col("shared") / F.col("weight"), -F.col("hamming"), -F.col("start"), "n"))
    return (
        verified.groupBy("key", "item_id").agg(best.alias("b"))
        .select("key", "item_id", F.col("b.col1").alias("similarity"), (-F.col("b.col3")).alias("start"),
                F.col("b.n").alias("n_words"), (-F.col("b.col2")).alias("hamming"))
    )


def find_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words, hamming): a row per document and item found in it.

    Repeated rows of ``docs(doc_id, text)`` each give their rows; clean documents give none.
    """
    found = written(contaminated_texts(docs, benchmark), "bench-found")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return keyed.join(sent_if_small(found), "key").drop("key")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with their columns."""
    found = written(contaminated_texts(docs, benchmark), "bench-found").select("key").distinct()
    bad = found.withColumnRenamed("key", "bench_key")
    return docs.join(sent_if_small(bad), text_key(F.col("text")) == F.col("bench_key"), "left_anti")
