"""Fuzzy line dedup: near-equal lines of all documents, one occurrence kept of each group.

Lines are normalised (lower case, digits as 0, punctuation and runs of blanks as one blank).
Each different one gets a SimHash of 192 bits over the set of the halves of its words, so that a
changed letter moves few bits, the fewer the longer the line. Its first blocks of 16 bits, 12 for
short lines and 8 for others, are keys, each with the class of the line's length. Two lines that
differ in fewer bits than they have keys agree in one for certain, lines farther apart most likely:
buckets, one for each key, bring them together. What is near there by fingerprint makes clusters; in
these, lines are linked that are near by edit similarity, and of each connected group the first
occurrence stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clusters import BLOCK, links_within, sent_if_small, spanning_links
from .common import (
    mixed,
    run_sums,
    small_batches,
    span_hasher,
    span_hashes,
    spans,
    text_bytes,
    written,
)
from .components import connected_components, roots

#: Fingerprints of 3 x 64 bits, in blocks of 16.
PRINT = ("p0", "p1", "p2")
BITS = 64 * len(PRINT)
BLOCK_BITS = 16
#: How many of them are keys, and the classes of the line's length.
KEYED = ("blocks", "low", "high")
#: Blocks that are keys, by the number of words: up to so many words, so many blocks.
BLOCKS = ((15, 12), (None, 8))
#: Lines of a class are at most so much longer than others (as a logarithm). One that an alike line
#: of the next class may be longer than is in that class, too.
CLASS_WIDTH = 0.6
CLASS_BITS = 6
#: Lines farther apart are not compared by their letters. Unrelated lines differ in about 88 bits,
#: a changed letter in one of ten words moves about 17, in one of forty 8.
RADIUS = 30
#: Buckets are compared by two parts of the fingerprint, which must not go apart by more than this:
#: some lines within ``RADIUS`` are lost here, which the measured recall takes in.
CARRIED = PRINT[:2]
CARRIED_RADIUS = 20
#: Edit similarity, 1 - distance / longer length, in percent.
PERCENT = 90
#: Shorter lines, after normalising, are never touched.
MIN_CHARS = 20
MIN_WORDS = 1
#: Buckets of more lines than this become clusters unseen.
LARGE_BUCKET = 8192
#: Rows of buckets that are compared at once.
ROWS_AT_ONCE = 60_000
#: Lines that a task knows to have fingerprinted.
KNOWN_LINES = 2_000_000
#: Bytes of text that are cut into lines at once: their arrays stay near the processor.
FITS_CACHE = 500_000

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("0") : ord("9") + 1] = ord("0")
_PLAIN[[c for c in range(128) if c != 10 and not chr(c).isalnum()]] = ord(" ")
_TABLE = _PLAIN.tobytes()
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Each part of a fingerprint has a hash of its own.
_SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_FOURS = np.uint64(0x1111111111111111)
_EIGHTS = np.uint64(0x0F0F0F0F0F0F0F0F)
GROUP = 15  # what four bits can count to
_MOST = 255  # and eight


def _planes(rows: np.ndarray) -> list[np.ndarray]:
    """How many of the rows have each bit, as binary digits, the lowest first; of 2^n - 1 rows."""
    out, rows = [], list(rows)
    while rows:
        digit, carried = rows[0], []
        for a, b in zip(rows[1::2], rows[2::2]):
            apart, carry = digit ^ a, digit & a
            digit = apart ^ b
            apart &= b
            carry |= apart
            carried.append(carry)
        out.append(digit)
        rows = carried
    return out


def simhashes(h: np.ndarray, count: np.ndarray, seeds: list[np.uint64]) -> np.ndarray:
    """64-bit SimHashes, a column for each seed, of runs of hashes that follow one another and have ``count`` > 0 items.

    Bits are counted in all places at once: ``GROUP`` items by binary digits, groups in counters of
    eight bits, eight of which share a number, ``_MOST`` items at a time.
    """
    groups = -(-count // GROUP)
    begin, ends = np.cumsum(groups) - groups, np.cumsum(count)
    # Row e has item e of every group, or no bits where a run has ended.
    at = np.arange(groups.sum()) * GROUP + np.repeat(ends - count - begin * GROUP, groups)
    at = at + np.arange(GROUP)[:, None]
    real = (at < np.repeat(ends, groups)) * np.uint64(0xFFFFFFFFFFFFFFFF)
    items = h.take(at, mode="clip")
    pieces = -(-groups // (_MOST // GROUP))
    owner = np.cumsum(pieces) - pieces
    step = np.arange(pieces.sum()) - np.repeat(owner, pieces)
    first = np.repeat(begin, pieces) + step * (_MOST // GROUP)
    short = len(first) == len(count)
    half = (count // 2)[:, None].astype(np.uint8 if short else np.int64)
    out = np.zeros((len(count), len(seeds)), np.uint64)
    for s, seed in enumerate(seeds):
        rows = items * seed
        rows += seed
        rows = mixed(rows)
        rows &= real
        planes = _planes(rows)
        for k in range(4):
            four = (planes[0] >> np.uint64(k)) & _FOURS
            for i, plane in enumerate(planes[1:], 1):
                four |= ((plane >> np.uint64(k)) & _FOURS) << np.uint64(i)
            for place, eight in ((k, four & _EIGHTS), (k + 4, (four >> np.uint64(4)) & _EIGHTS)):
                votes = np.add.reduceat(eight, first).view(np.uint8).reshape(-1, 8)
                if not short:
                    votes = np.add.reduceat(votes.astype(np.int64), owner, axis=0)
                # A flag is a byte, 0 or 1: eight of them are a number again, with a bit in each lane.
                out[:, s] |= (votes > half).view(np.uint64)[:, 0] << np.uint64(place)
    return out


class Lines:
    """The lines of a batch that are long enough: text, number, name, words and their halves.

    ``kept`` is what ``run_sums`` keeps from one batch to the next.
    """

    def __init__(self, column: pa.Array, kept: dict | None = None) -> None:
        data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
        data = np.frombuffer(data.tobytes().translate(_TABLE), np.uint8)
        is_break = data == 10
        starts, ends, at = spans(~is_break, offsets)
        breaks = np.flatnonzero(is_break)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets)[text]
        borders = np.append(starts, len(data))
        w_start, w_end, w_at = spans((data != 32) & ~is_break, borders)
        n_words = np.diff(w_at)
        # Characters: the bytes of the words, but for those that continue a character.
        sizes = np.concatenate([[0], np.cumsum(w_end - w_start)])
        inner = np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), borders)
        length = sizes[w_at[1:]] - sizes[w_at[:-1]] - np.diff(inner) + np.maximum(n_words - 1, 0)
        good = (n_words >= MIN_WORDS) & (length >= MIN_CHARS)
        self.text, self.number, self.n = text[good], number[good], n_words[good]
        self.length = length[good]
        middle = w_start + (w_end - w_start + 1) // 2
        hashes = span_hasher(data, kept)
        halves = np.stack([hashes(w_start, middle), mixed(hashes(middle, w_end) + np.uint64(1))], 1)
        # A word of one byte has one half only.
        real = np.ones(halves.shape, bool)
        real[:, 1] = middle < w_end
        self.halves = halves[real]
        half_at = 2 * w_at - np.searchsorted(np.flatnonzero(~real[:, 1]), w_at)
        self.first, self.count = half_at[:-1][good], np.diff(half_at)[good]
        sums = run_sums(self.halves, _STEP, kept)(self.first, self.first + self.count)
        self.name = mixed(sums + self.count.astype(np.uint64))

    def prints(self, lines: np.ndarray) -> np.ndarray:
        """Fingerprints of these lines, one row each: over the set of the halves of their words."""
        if not len(lines):
            return np.empty((0, len(PRINT)), np.uint64)
        count = self.count[lines]
        before = np.cumsum(count) - count
        both = self.halves[np.arange(count.sum()) + np.repeat(self.first[lines] - before, count)]
        # The line above 44 bits of the hash: sorted, equal halves of a line are neighbours.
        line = np.arange(len(lines) + 1, dtype=np.uint64) << np.uint64(44)
        both >>= np.uint64(20)
        both |= np.repeat(line[:-1], count)
        both.sort()
        both = both[np.append(True, both[1:] != both[:-1])]
        count = np.diff(np.searchsorted(both, line))
        both &= np.uint64((1 << 44) - 1)
        return simhashes(both, count, _SEEDS)

    def blocks(self, lines: np.ndarray) -> np.ndarray:
        """How many blocks of these lines' fingerprints are keys."""
        borders = [most for most, _ in BLOCKS if most is not None]
        return np.array([blocks for _, blocks in BLOCKS])[np.searchsorted(borders, self.n[lines])]

    def classes(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last class of these lines' lengths."""
        size = np.log(self.length[lines]) / CLASS_WIDTH
        margin = -np.log(PERCENT / 100) / CLASS_WIDTH + 1e-9
        most = (1 << CLASS_BITS) - 1
        return np.minimum(size.astype(int), most), np.minimum((size + margin).astype(int), most)


def plain(lines: list[str]) -> list[str]:
    """Lines as they are normalised."""
    lower = pc.utf8_lower(pa.array(lines, pa.string())).to_pylist()
    return [b" ".join(x.encode().translate(_TABLE).split()).decode() for x in lower]


def with_identity(docs: DataFrame) -> DataFrame:
    """``docs`` with ``line_text_hash``, which with the id tells rows apart that differ."""
    return docs.withColumn("line_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def occurrences(docs: DataFrame) -> DataFrame:
    """(node, p0 .. p2, blocks, low, high, doc_id, th, number): every line that is long enough, named by its hash.

    A task fingerprints a line where it first meets it; elsewhere the columns of ``PRINT`` and
    ``KEYED`` are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kept = np.empty(0, np.uint64), {}
        for batch in small_batches(batches, limit=FITS_CACHE):
            lines = Lines(batch.column("text"), kept)
            names, first = np.unique(lines.name, return_index=True)
            place = np.searchsorted(known, names)
            new = place == len(known)
            new[~new] = known[place[~new]] != names[~new]
            both = [known, names[new]] if len(known) < KNOWN_LINES else [names]
            known = np.sort(np.concatenate(both), kind="stable")
            at = np.sort(first[new])
            where = np.full(len(lines.name), -1)
            where[at] = np.arange(len(at))
            prints = lines.prints(at).view(np.int64)
            row = pa.array(lines.text)
            own = pa.array(where, mask=where < 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lines.name.view(np.int64)),
                    *[pa.array(np.ascontiguousarray(prints[:, i])).take(own) for i in range(len(PRINT))],
                    *[pa.array(x.astype(np.int32)).take(own) for x in (lines.blocks(at), *lines.classes(at))],
                    batch.column("doc_id").take(row), batch.column("th").take(row),
                    pa.array(lines.number.astype(np.int32)),
                ],
                ["node", *PRINT, *KEYED, "doc_id", "th", "number"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    parts, keyed = ", ".join(f"{p} long" for p in PRINT), ", ".join(f"{c} int" for c in KEYED)
    return docs.select("doc_id", F.col("line_text_hash").alias("th"), "text").mapInArrow(
        run, f"node long, {parts}, {keyed}, doc_id {kind}, th long, number int"
    )


def _line_texts(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """(node, p0 .. p2, line): normalised lines of ``spots(node, p0 .. p2, doc_id, th, number)``."""
    names = ["node", *PRINT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows, lines = [], []
            for text, spots in zip(batch.column("text").to_pylist(), batch.column("spots").to_pylist()):
                own = (text or "").split("\n")
                rows += spots
                lines += [own[s["number"]] for s in spots]
            columns = [pa.array([r[c] for r in rows], pa.int64()) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(plain(lines), pa.string())], [*names, "line"])

    by_doc = spots.groupBy(F.col("doc_id").alias("spot_id"), F.col("th").alias("spot_th")).agg(
        F.collect_list(F.struct(*names, "number")).alias("spots")
    )
    rows = docs.join(
        sent_if_small(written(by_doc, "line-spots")),
        F.col("doc_id").eqNullSafe(F.col("spot_id")) & (F.col("line_text_hash") == F.col("spot_th")),
    )
    return rows.select("text", "spots").mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", line string")


def _keys() -> Column:
    """The numbers of a line's keys: one for each block, twice if the line is in two classes."""
    classes = F.when(F.col("low") == F.col("high"), 1).otherwise(2)
    return F.sequence(F.lit(0), F.col("blocks") * classes - 1)


def _key(number: Column) -> Column:
    """The key of that number: the bits of a block, which one, and a class of the length.

    Made of one number at a time, as code for all blocks at once is too long to be compiled.
    """
    block = F.pmod(number, F.col("blocks"))
    size = F.when(number < F.col("blocks"), F.col("low")).otherwise(F.col("high"))
    each = 64 // BLOCK_BITS
    part = F.when(block < each, F.col(PRINT[0]))
    for i, p in enumerate(PRINT[1:-1], 1):
        part = part.when(block < each * (i + 1), F.col(p))
    at = F.pmod(block, F.lit(each)) * BLOCK_BITS
    bits = F.call_function("shiftrightunsigned", part.otherwise(F.col(PRINT[-1])), at)
    bits = bits.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    return bits.bitwiseOR(F.shiftleft(size, BLOCK_BITS)).bitwiseOR(F.shiftleft(block, BLOCK_BITS + CLASS_BITS))


def _block_of(key: np.ndarray) -> np.ndarray:
    """Which block a key is made of."""
    return key >> (BLOCK_BITS + CLASS_BITS)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, rows of numbers."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _first_key(apart: np.ndarray) -> np.ndarray:
    """Number of the first block that two fingerprints share, from what they differ in; or past the last."""
    blocks = np.ascontiguousarray(apart).view(f"<u{BLOCK_BITS // 8}")
    shared = np.concatenate([blocks == 0, np.ones((*blocks.shape[:-1], 1), bool)], -1)
    return shared.argmax(-1)


def _near_pairs(
    key: np.ndarray, print_: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows, sorted by key, that have one key and are within the radius."""
    if not len(key):
        return
    first, second, *rest = (np.ascontiguousarray(x) for x in print_.T)
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(key))
    i = np.flatnonzero(room > 1)
    d = 1
    while len(i):
        j = i + d
        apart = np.bitwise_count(first[i] ^ first[j])
        apart += np.bitwise_count(second[i] ^ second[j])
        near = np.flatnonzero(apart <= radius)
        a, b = i[near], j[near]
        total = apart[near].astype(np.int64)
        for part in rest:
            total += np.bitwise_count(part[a] ^ part[b])
        good = total <= radius
        yield a[good], b[good]
        d += 1
        i = i[room[i] > d]


def _rows_of(batch: pa.RecordBatch, parts: tuple[str, ...], *names: str) -> tuple[np.ndarray, ...]:
    """Columns as arrays, and the parts of the fingerprints as rows of numbers."""
    prints = np.stack([batch.column(p).to_numpy() for p in parts], 1).view(np.uint64)
    return (*[batch.column(c).to_numpy().astype(np.int64) for c in names], prints)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``ROWS_AT_ONCE``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_ONCE:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def near_by_print(lines: DataFrame) -> DataFrame:
    """(u, v) that connect all lines of ``lines(node, p0 .. p2)`` that are near in a bucket, and few others.

    Rows come sorted by key, so that a task holds one bucket at a time. A bucket of more than
    ``LARGE_BUCKET`` lines is not compared here: its lines are linked to its first one, as
    they pass by.
    """

    def links(key: np.ndarray, node: np.ndarray, print_: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        pairs = list(_near_pairs(key, print_, CARRIED_RADIUS))
        if not pairs:
            return []
        u, v = (node[np.concatenate(x)] for x in zip(*pairs))
        return [roots(u, v)] if len(u) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, centre = None, None
        for batch in _gathered(batches):
            rows = _rows_of(batch, CARRIED, "key", "node")
            out = []
            if centre is not None:
                same = int(np.searchsorted(rows[0], centre[0], side="right"))
                out.append((rows[1][:same], np.full(same, centre[1])))
                rows = tuple(x[same:] for x in rows)
                centre = centre if not len(rows[0]) else None
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows))
            if len(rows[0]):
                cut = int(np.searchsorted(rows[0], rows[0][-1]))
                out += links(*(x[:cut] for x in rows))
                held = tuple(x[cut:] for x in rows)
                if len(held[0]) > LARGE_BUCKET:
                    centre = (held[0][0], held[1][0])
                    out.append((held[1], np.full(len(held[1]), centre[1])))
                    held = None
            yield from _links(out)
        if held is not None:
            yield from _links(links(*held))

    return (
        lines.select(F.explode(_keys()).alias("i"), "node", *PRINT, *KEYED)
        .select(_key(F.col("i")).alias("key"), "node", *CARRIED)
        .repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")
    )


def _links(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Links between different lines, as a batch."""
    if parts:
        u, v = (np.concatenate(x) for x in zip(*parts))
        real = u != v
        if real.any():
            yield pa.RecordBatch.from_arrays([pa.array(u[real]), pa.array(v[real])], ["u", "v"])


def _common(a: str, b: str) -> int:
    """How many first characters two texts share."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Two texts without what both begin and end with."""
    head = _common(a, b)
    a, b = a[head:], b[head:]
    tail = _common(a[::-1], b[::-1])
    return a[: len(a) - tail], b[: len(b) - tail]


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance by Myers' bit vectors, without what both begin and end with.

    ``most + 1`` if it is certainly larger than ``most``.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    a, b = _trimmed(a, b)
    if not a or not b:
        return max(len(a), len(b))
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        eq = place.get(c, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(d | plus) & full, plus & d
        score += bool(up & last) - bool(down & last)
        if score - left > most:
            return most + 1
        up = (up << 1 | 1) & full
        plus, minus = (down << 1 & full) | ~(x | up) & full, up & x
    return score


#: Words that two lines may go apart by before they meet again, for ``word_edits``.
LOOK_AHEAD = 4
#: How many words of either line to pass over, the fewest first.
_STEPS = sorted(
    ((n, m) for n in range(LOOK_AHEAD + 1) for m in range(LOOK_AHEAD + 1) if 0 < n + m < 2 * LOOK_AHEAD),
    key=lambda s: (s[0] + s[1], abs(s[0] - s[1]), s[0]),
)


def word_edits(a: str, b: str, most: int) -> int:
    """A number of edits that turns ``a`` into ``b``, word for word; not always the least one.

    ``most + 1`` if more, or if the lines do not meet again within a few words. Words that differ
    count whole; only if that is too much their letters are compared.
    """
    x, y = a.split(" "), b.split(" ")
    # Both ends meet; what lies beyond meets nothing.
    x += [None, *range(LOOK_AHEAD)]
    y += [None, *range(-LOOK_AHEAD, 0)]
    i = j = cost = least = 0
    changed = []
    while x[i] is not None or y[j] is not None:
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for n, m in _STEPS:
            if x[i + n] == y[j + m]:
                break
        else:
            return most + 1
        old, new = " ".join(x[i : i + n]), " ".join(y[j : j + m])
        if n and m:
            changed.append((old, new))
            cost += max(len(old), len(new))
            least += abs(len(old) - len(new))
        else:
            # One side without a word also lacks the blank beside it.
            cost += len(old) + len(new) + 1
            least += len(old) + len(new) + 1
        if least > most:
            return most + 1
        i, j = i + n, j + m
    for old, new in changed:
        if cost <= most or least > most:
            break
        real = edit_distance(old, new, most)
        cost -= max(len(old), len(new)) - real
        least += real - abs(len(old) - len(new))
    return min(cost, most + 1)


def alike(a: str, b: str, percent: int = PERCENT) -> bool:
    """Whether the edit similarity is ``percent`` or more."""
    answer = quick_answer(a, b, percent)
    return answer if isinstance(answer, bool) else edit_distance(*answer) <= answer[2]


def quick_answer(a: str, b: str, percent: int = PERCENT) -> bool | tuple[str, str, int]:
    """Whether two lines are alike, or what is left to compare and the most edits that it may take.

    Two answers are quick: changing word for word is one way to get from one to the other, and
    letters that one line has more of than the other are edits at the least.
    """
    longer = max(len(a), len(b))
    most = longer * (100 - percent) // 100
    if abs(len(a) - len(b)) > most:
        return False
    a, b = _trimmed(a, b)
    if max(len(a), len(b)) <= most:
        return True
    if len(a) <= 2 * GRAIN or len(b) <= 2 * GRAIN:
        return edit_distance(a, b, most) <= most
    if word_edits(a, b, most) <= most:
        return True
    return False if _lacking(a, b) > most else (a, b, most)


#: Bits of the bands that are moved on together, and rows of bits made at once.
BAND_BITS = 8192
BAND_CELLS = 2_000_000


def within(pairs: list[tuple[str, str, int]]) -> np.ndarray:
    """Whether each two texts are at most so many edits apart: pairs of like lengths at once."""
    out = np.zeros(len(pairs), bool)
    near = [x for x, (a, b, most) in enumerate(pairs) if abs(len(a) - len(b)) <= most]
    group, bits = [], 0
    for x in sorted(near, key=lambda x: min(len(pairs[x][0]), len(pairs[x][1]))):
        group.append(x)
        bits += 2 * pairs[x][2] + 2
        if bits >= BAND_BITS:
            out[group] = _within_bands([pairs[x] for x in group])
            group, bits = [], 0
    if group:
        out[group] = _within_bands([pairs[x] for x in group])
    return out


def _within_bands(pairs: list[tuple[str, str, int]]) -> np.ndarray:
    """``within`` by Myers' bit vectors, of the band about the diagonal only, all pairs in one number.

    A pair has a field of bits. In the column of the shorter text's letter j, bit t is the longer
    one's letter j - most + t; a spare bit above takes what an addition carries over.
    """
    texts = [
        [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32) for t in sorted((a, b), key=len)]
        for a, b, _ in pairs
    ]
    short, long = (np.array([len(t[i]) for t in texts]) for i in (0, 1))
    most = np.array([p[2] for p in pairs])
    size = -(-(2 * most + 2) // 8) * 8
    first = np.cumsum(size) - size
    n_bytes = int(size.sum()) // 8
    padded = [np.full(len(a) + 2 * k, -1, np.int32) for (a, _), k in zip(texts, most.tolist())]
    for whole, (_, b), k in zip(padded, texts, most.tolist()):
        whole[k : k + len(b)] = b
    mask = plus = minus = 0
    for k, at in zip(most.tolist(), first.tolist()):
        mask |= (1 << 2 * k + 1) - 1 << at
        plus |= (1 << k + 1) - 1 << at + k
    # On the diagonal that ends both texts a bit says that the distance does not grow.
    end = first + long - short + most
    agreed = np.zeros(len(pairs), np.int64)
    rows = max(1, BAND_CELLS // (8 * n_bytes))
    for j in range(0, int(short.max()), rows):
        own = min(rows, int(short.max()) - j)
        equal = np.zeros((own, 8 * n_bytes), bool)
        for (text, _), whole, k, at in zip(texts, padded, most.tolist(), first.tolist()):
            letters = text[j : j + own]
            if len(letters):
                # Row by row the same letters, one place on.
                bands = np.ndarray((len(letters), 2 * k + 1), np.int32, whole, 4 * j, (4, 4))
                np.equal(bands, letters[:, None], out=equal[: len(letters), at : at + 2 * k + 1])
        moves = []
        for row in np.packbits(equal, axis=1, bitorder="little"):
            eq = int.from_bytes(row.tobytes(), "little")
            same = (((eq & plus) + plus) ^ plus | eq | minus) & mask
            up, down = minus | mask ^ (same | plus), same & plus
            below = same >> 1 & mask
            plus, minus = down | mask ^ (below | up), below & up
            moves.append(same.to_bytes(n_bytes, "little"))
        seen = np.frombuffer(b"".join(moves), np.uint8).reshape(own, n_bytes)[:, end >> 3]
        live = np.arange(j, j + own)[:, None] < short
        agreed += ((seen >> (end & 7).astype(np.uint8) & 1).astype(bool) & live).sum(0)
    return long - agreed <= most


#: Middles of lines up to twice this long are compared at once.
GRAIN = 16


def _lacking(a: str, b: str) -> int:
    """Edits that it takes at least: characters of one text that the other lacks."""
    x, y = (np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) & 1023, minlength=1024) for t in (a, b))
    apart = x - y
    return int(max(apart[apart > 0].sum(), -apart[apart < 0].sum()))


def _has_partner(key: np.ndarray, print_: np.ndarray) -> np.ndarray:
    """Per row of sorted buckets whether another one is near for which this is the first key."""
    out = np.zeros(len(key), bool)
    for i, j in _near_pairs(key, print_, RADIUS):
        first = _first_key(print_[i] ^ print_[j]) == _block_of(key[i])
        out[i[first]] = out[j[first]] = True
    return out


def _partners(rows: DataFrame) -> DataFrame:
    """(node, root) of ``rows(root, node, p0 .. p2)``, whole buckets, that have a partner there."""

    def kept(root: np.ndarray, node: np.ndarray, print_: np.ndarray) -> Iterator[pa.RecordBatch]:
        good = _has_partner(root, print_)
        if good.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[good]), pa.array(root[good])], ["node", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = _rows_of(batch, PRINT, "root", "node")
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows))
            cut = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
            yield from kept(*(x[:cut] for x in rows))
            held = tuple(x[cut:] for x in rows)
        if held is not None:
            yield from kept(*held)

    return (
        rows.select(F.col("root").cast("long").alias("root"), "node", *PRINT)
        .repartition("root").sortWithinPartitions("root").mapInArrow(run, "node long, root long")
    )


#: Pairs of fingerprints that are compared at once.
PAIRS_AT_ONCE = 200_000
#: Letters of pairs that wait to be compared together.
ASKED_CHARS = 2_000_000


def _quick_links(lines: list[str], pairs: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], dict]:
    """Index pairs that link what quick answers link, and what is to be compared of the pairs left."""
    asked, size = {}, 0

    def linked(i: int, j: int) -> bool:
        nonlocal size
        answer = quick_answer(lines[i], lines[j])
        if isinstance(answer, bool):
            return answer
        if size > ASKED_CHARS:
            return edit_distance(*answer) <= answer[2]
        asked[i, j] = answer
        size += len(answer[0]) + len(answer[1])
        return False

    links = spanning_links(range(len(lines)), pairs, linked)
    if not asked:
        return links, asked
    # Later links may have connected a pair that was put off.
    known, left = set(links), {}

    def is_known(i: int, j: int) -> bool:
        if (i, j) not in known:
            left[i, j] = asked[i, j]
        return (i, j) in known

    spanning_links(range(len(lines)), [*links, *asked], is_known)
    return links, left


def _spanning(held: list[tuple[list[int], list[tuple[int, int]], dict]]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of groups (nodes, links, pairs to be compared), the pairs of all of them at once."""
    answers = iter(within([pair for _, _, asked in held for pair in asked.values()]).tolist())
    out = []
    for nodes, links, asked in held:
        out += spanning_links(nodes, [*links, *(pair for pair in asked if next(answers))])
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["u", "v"])


def _confirmed(placed: DataFrame, texts: DataFrame, by_key: bool) -> DataFrame:
    """Links of ``placed(cluster, block, node, visitor)`` by fingerprint and edit similarity; texts have both.

    With ``by_key`` clusters are buckets, named by their key, and two lines are compared in the
    first bucket that they share only.
    """

    def pairs_of(key: tuple[int, int], group: list) -> list[tuple[int, int]]:
        p = np.array([g[1] for g in group], np.int64).view(np.uint64)
        visitor = np.array([g[2] for g in group])
        found = []
        rows = max(1, PAIRS_AT_ONCE // len(group))
        for start in range(0, len(group), rows):
            own = slice(start, start + rows)
            apart = _apart(p[own, None], p)
            near = np.triu(apart <= RADIUS, start + 1) & ~(visitor[own, None] & visitor)
            i, j = near.nonzero()
            apart, i = apart[i, j], i + start
            if by_key:
                first = _first_key(p[i] ^ p[j]) == _block_of(key[0])
                apart, i, j = apart[first], i[first], j[first]
            found += zip(apart.tolist(), i.tolist(), j.tolist())
        # The nearest first: what they connect need not be compared by letters again.
        return [(i, j) for _, i, j in sorted(found)]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list]]:
        key, group = None, []
        for batch in small_batches(batches, "line"):
            columns = [batch.column(c).to_pylist() for c in ("cluster", "block", "node", "visitor", "line")]
            prints = zip(*(batch.column(p).to_pylist() for p in PRINT))
            for cluster, block, *rest in zip(columns[0], columns[1], columns[2], prints, columns[3], columns[4]):
                if (cluster, block) != key:
                    if len(group) > 1:
                        yield key, group
                    key, group = (cluster, block), []
                group.append(rest)
        if len(group) > 1:
            yield key, group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for key, group in groups(batches):
            nodes, lines = [g[0] for g in group], [g[3] for g in group]
            links, asked = _quick_links(lines, pairs_of(key, group))
            held.append((nodes, links, asked))
            size += len(links) + sum(len(a) + len(b) for a, b, _ in asked.values())
            if size > ASKED_CHARS:
                yield from _spanning(held)
                held, size = [], 0
        yield from _spanning(held)

    return (
        texts.join(sent_if_small(placed), "node")
        .select("cluster", "block", "node", *PRINT, "visitor", "line")
        .repartition("cluster", "block")
        .sortWithinPartitions("cluster", "block")
        .mapInArrow(run, "u long, v long")
    )


def _all_links(clusters: DataFrame, lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) that connect what is alike in the clusters.

    A cluster of a block's size is one group to compare. Short lines chain into larger ones
    that hold few links; there the lines of a bucket are a group, those that have a near line
    in it and in no bucket before it.
    """
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    sized = written(clusters.join(sizes, "root"), "line-sized")
    small = sized.filter(F.col("n") <= BLOCK).select("node", "root")
    links = links_within(small, lambda placed: _confirmed(placed, texts, False))
    wide = sized.filter(F.col("n") > BLOCK).select("node")
    if wide.isEmpty():
        return links
    wide = lines.join(sent_if_small(wide), "node")
    wide = wide.select(F.explode(_keys()).alias("i"), "node", *PRINT, *KEYED)
    wide = written(wide.select("node", *PRINT, _key(F.col("i")).alias("root")), "line-buckets")
    full = wide.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1")
    wide = written(wide.join(full, "root"), "line-buckets")
    buckets = _partners(wide.filter(F.col("n") <= LARGE_BUCKET)).unionByName(
        wide.filter(F.col("n") > LARGE_BUCKET).select("node", F.col("root").cast("long").alias("root"))
    )
    buckets = written(buckets, "line-buckets")
    return links.unionByName(links_within(buckets, lambda placed: _confirmed(placed, texts, True)))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, drop): per document the numbers of its lines that repeat an earlier one.

    The first occurrence of a group is the one with the smallest doc_id (null last), text hash
    and line number; all others are to go. Rows that repeat id and text are one document.
    """
    found = written(occurrences(docs), "line-found")
    # Equal lines have equal fingerprints, whichever task made them.
    seen = found.filter(F.col(PRINT[0]).isNotNull())
    lines = written(seen.groupBy("node").agg(*[F.max(p).alias(p) for p in (*PRINT, *KEYED)]), "line-names")
    clusters = written(connected_components(near_by_print(lines)), "line-clusters")
    spots = seen.join(sent_if_small(clusters.select("node")), "node").dropDuplicates(["node"])
    texts = written(_line_texts(docs, spots), "line-texts")
    joined = connected_components(_all_links(clusters, lines, texts))
    grouped = found.join(sent_if_small(joined), "node", "left").select(
        F.coalesce("root", "node").alias("line_group"), "doc_id", "th", "number"
    )
    # Most lines are alone in their group: spots are compared for the others only.
    shared = grouped.groupBy("line_group").agg(F.count("*").alias("n")).filter("n > 1").select("line_group")
    several = sent_if_small(written(shared, "line-groups"))
    members = written(grouped.join(several, "line_group"), "line-members")
    spot = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "number")
    first = written(members.groupBy("line_group").agg(F.min(spot).alias("first")), "line-first")
    again = members.join(sent_if_small(first), "line_group").filter(spot != F.col("first"))
    return again.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("number")).alias("drop"))


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` shortened, and ``n_lines`` and ``n_dropped`` (columns of those names give way).

    ``docs`` has an integer ``doc_id`` and ``text``. Null texts stay null and have no lines, empty
    ones have one; lines too short to judge are kept wherever they are.
    """
    out = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    marked = with_identity(docs.select(*out))
    drops = written(repeated_lines(marked), "line-drops").select(
        F.col("doc_id").alias("drop_id"), F.col("th").alias("drop_th"), "drop"
    )
    rows = marked.join(
        sent_if_small(drops),
        F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("line_text_hash") == F.col("drop_th")),
        "left",
    )
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("drop", i)), "\n")
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(left)
    return rows.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in out],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
    )
