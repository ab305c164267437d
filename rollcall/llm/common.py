"""Helpers that the operators share: where to write, and words of whole texts as arrays.

Inside a task, texts are worked on as the bytes of an Arrow column, a few megabytes at a time:
spans of words, 64-bit hashes of spans, shingles. Everything else is Spark's.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: anything but ASCII whitespace.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of text worked on at once; one longer text is still taken whole.
CHUNK_BYTES = 2_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, ``spark.checkpoint.dir``.

    Only a local session without that setting gets one of its own on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, unique: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` left joined with ``unique``, which has one row per ``key``; hot keys stay spread.

    ``count`` (left out of the result) says how many of ``total`` rows have the key. Keys with
    over a thousandth of them, fewer than a thousand, are sent to every task; the others meet by
    shuffling. Both sides are read twice: give them written, or cheap to read.
    """
    hot = F.broadcast(unique.filter(F.col(count) * 1000 > total).drop(count))
    other = unique.filter(F.col(count) * 1000 <= total).drop(count)
    rest = rows.join(hot.select(key), key, "left_anti").join(other, key, "left")
    return rows.join(hot, key).unionByName(rest)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or one row each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        total = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(sizes):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins; null is empty."""
    whole = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(whole) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def solid(data: np.ndarray) -> np.ndarray:
    """True where a byte is not whitespace."""
    return _SOLID[data]


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``mask``, none over the border of two texts; runs per text.

    The third array says where the runs of each text begin, as ``offsets`` does for bytes.
    """
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    opens[full] = mask[full]
    closes = mask.copy()
    closes[:-1] &= ~mask[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    closes[last] = mask[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)
_STEP = np.uint64(0xAF251AF3B0F025B5)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    factors = np.full(max(n, 1), base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans hash alike in every task.

    Spans are in order, not empty, and do not overlap.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    first, last = starts[0], ends[-1]
    reach = np.diff(np.append(starts, last))
    place = np.arange(last - first) - np.repeat(starts - first, reach)
    values = _BYTES.take(data[first:last], mode="wrap")
    values *= powers(_BASE, int(reach.max()))[place]
    borders = np.stack([starts, ends], 1).reshape(-1)[:-1] - first
    sums = np.add.reduceat(values, borders)[::2]
    return mixed(sums + (ends - starts).astype(np.uint64))


#: Powers up to so many are kept for a task's next batch.
KEPT_POWERS = 1 << 20


def run_sums(
    values: np.ndarray, base: np.uint64, kept: dict | None = None
) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of starts and ends: the sum of each such run of ``values``, weighed by 1, base, base^2, ...

    All modulo 2^64, where an odd ``base`` has an inverse: differences of the sums from the first
    value on, weighed back. ``kept`` holds the powers from one call to the next.
    """
    n = len(values)
    kept = {} if kept is None or n >= KEPT_POWERS else kept
    if len(kept.get(base, ((),))[0]) <= n:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        kept[base] = powers(base, n + n // 4 + 1), powers(inverse, n + n // 4 + 1)
    weights, back = kept[base]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * weights[:n], out=sums[1:])

    def of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = sums[ends]
        out -= sums[starts]
        out *= back[starts]
        return out

    return of


def span_hasher(data: np.ndarray, kept: dict | None = None) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """``span_hashes`` of any spans of the same bytes, which are gone through once."""
    of = run_sums(_BYTES.take(data, mode="wrap"), _BASE, kept)
    return lambda starts, ends: mixed(of(starts, ends) + (ends - starts).astype(np.uint64))


def windows(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` items that lie in one text, and the item each starts at."""
    if len(h) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    step = powers(_STEP, k)
    size = len(h) - k + 1
    total = np.zeros(size, np.uint64)
    for j in range(k):
        total += h[j : size + j] * step[j]
    room = np.repeat(offsets[1:], np.diff(offsets))[:size]
    at = np.flatnonzero(np.arange(size) + k <= room)
    return mixed(total[at] + np.uint64(k)), at


def shingle_sets(h: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text its distinct ``k``-word shingles, sorted; a shorter text is one shingle whole."""
    values, at = windows(h, offsets, k)
    cut = np.searchsorted(at, offsets)
    sets = []
    for i in range(len(offsets) - 1):
        own = values[cut[i] : cut[i + 1]]
        n = offsets[i + 1] - offsets[i]
        if 0 < n < k:
            whole = (h[offsets[i] : offsets[i + 1]] * powers(_STEP, k)[:n]).sum(dtype=np.uint64)
            own = mixed(np.array([whole], np.uint64) + np.uint64(n))
        sets.append(np.unique(own))
    return sets


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts end to end, and where each begins; null is empty."""
    texts = [t or "" for t in texts]
    data = "".join(texts).encode("utf-32-le", "surrogatepass")
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer(data, np.uint32), offsets
