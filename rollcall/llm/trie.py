"""The prefix trie of conversations, from the common prefixes of sorted neighbours.

Conversations become sequences of turn digests. Equal ones are one row; rows are range-partitioned
and sorted, so that all conversations under a trie node are neighbours, and the common prefix of
two neighbours (LCP) is an edge between them. Inside a partition, union-find joins the edges in
descending depth: components stay intervals of rows, every merge makes or widens a branching node, and
the turns between it and the node above form its chain. Nodes that reach over a partition's border
are handed on as pieces; pieces of one node, known by the LCPs at the borders, are summed up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .clusters import sent_if_small
from .common import WORD, written

#: Bytes of a turn's digest.
DIGEST = 16
#: Turns that a conversation may take from another one, at most.
MOST_HEAD = 3
#: Bytes of ids that are handed on at once.
ID_BYTES = 1_000_000
#: SHA-256 of nothing.
NO_ENDS = hashlib.sha256(b"").hexdigest()


def head_length(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the one that it branches off: 0 to 3."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def branched_turns(conversations: DataFrame, every: int = 20, head: Column | None = None) -> DataFrame:
    """(conv_id, seq, words) per conversation: its turns' digests end to end, and their word counts.

    The first ``head`` turns are those of conversation ``conv_id - conv_id % every`` (all if it
    has fewer, none if it is absent), then come the conversation's own after its first ``head``.
    Turns are ordered by turn (null first), then role, then text; null role or text is empty.
    Rows without a conv_id take no part. A turn takes 20 bytes here, however long its text is.
    """
    head = head_length(F.col("conv_id")) if head is None else head
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    named = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = turns.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        F.md5(named.cast("binary")).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).alias("words"),
    )
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("own"))
    own = written(own.withColumn("head", head), "trie-turns")
    stem = F.slice("own", 1, MOST_HEAD).alias("stem")
    stems = own.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("stem_id"), stem)
    both = own.join(stems, F.col("conv_id") - F.col("conv_id") % every == F.col("stem_id"), "left")
    stem = F.when(F.col("stem").isNotNull(), F.slice("stem", F.lit(1), F.col("head"))).otherwise(F.slice("own", 1, 0))
    rest = F.filter("own", lambda t: t["place"] > F.col("head"))
    both = both.select("conv_id", F.concat(stem, rest).alias("turns"))
    seq = F.unhex(F.array_join(F.col("turns.digest"), ""))
    return both.select("conv_id", seq.alias("seq"), F.col("turns.words").alias("words"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two sequences share."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    x, y = (np.frombuffer(s, f"V{DIGEST}", n) for s in (a, b))
    return int(np.argmin(x == y))


_SORTED = (
    "part int, at long, len int, lcp int, conv_id long, n long, words array<int>, ends binary, edge binary"
)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the LCP to the row before, -1 at the first; ``edge`` at first and last row."""
    part, at, before = TaskContext.get().partitionId(), 0, None

    def row(seq: bytes, lcp: int, conv_id: int, n: int, words: list[int], edge: bool) -> tuple:
        ends = hashlib.md5(seq, usedforsecurity=False).digest()
        return part, at, len(seq) // DIGEST, lcp, conv_id, n, words, ends, seq if edge else None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [
            pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()),
            pa.binary(), pa.binary(),
        ]
        names = [x.split()[0] for x in _SORTED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    for batch in batches:
        out = []
        for seq, conv_id, n, words in zip(*(c.to_pylist() for c in batch.columns)):
            if before is not None:
                out.append(row(*before, before[1] < 0))
                at += 1
            before = (seq, -1 if before is None else common_turns(before[0], seq), conv_id, n, words)
        if out:
            yield batch_of(out)
    if before is not None:
        yield batch_of([row(*before, True)])


def _borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Partition -> the LCP of its first row with the last one before (-1: none), and its least LCP
    inside (of a single row: its length). Two numbers per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out = []
            for part, lcp, edge in zip(*(c.to_pylist() for c in batch.columns)):
                if lcp < 0:
                    out.append((part, -1 if before is None else common_turns(before, edge)))
                before = edge
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in zip(*out)], ["part", "lcp"])

    edges = rows.filter("edge is not null").select("part", "at", "lcp", "edge").coalesce(1)
    edges = edges.sortWithinPartitions("part", "at").select("part", "lcp", "edge")
    before = {r["part"]: r["lcp"] for r in edges.mapInArrow(run, "part int, lcp int").collect()}
    least = F.coalesce(F.min(F.when(F.col("lcp") >= 0, F.col("lcp"))), F.min("len"))
    inside = rows.groupBy("part").agg(least.alias("least")).collect()
    return {r["part"]: (before[r["part"]], r["least"]) for r in sorted(inside, key=lambda r: r["part"])}


class Components:
    """Union-find over the LCP edges of sorted rows, in descending depth.

    ``lcp[i]`` is the edge between rows i - 1 and i. A component is an interval of rows and the
    chain of nodes that have just these rows, from depth ``above + 1`` down to ``depth``, where rows
    part or end; ``edges`` counts the merges at that depth, ``least`` is the smallest id.
    ``parent`` is the component that the chain hangs from (the last one: itself).
    """

    def __init__(self, lcp: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        m = len(length)
        root, left, right = list(range(m)), list(range(m)), list(range(m))
        depth, edges, least = length.tolist(), [0] * m, ids.tolist()
        hanging: list[list[int]] = [[] for _ in range(m)]
        done: list[tuple] = []
        parent: list[int] = []

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def close(x: int, above: int) -> int:
            for child in hanging[x]:
                parent[child] = len(done)
            parent.append(len(done))
            done.append((left[x], right[x], above, depth[x], edges[x], least[x]))
            return len(done) - 1

        for i in (np.argsort(-lcp[1:], kind="stable") + 1).tolist():
            d = int(lcp[i])
            a, b = find(i - 1), find(i)
            merges = 1
            for x in (a, b):
                if depth[x] > d:
                    hanging[x] = [close(x, d)]
                else:
                    merges += edges[x]
            if len(hanging[a]) < len(hanging[b]):
                a, b = b, a
            root[b] = a
            hanging[a] += hanging[b]
            hanging[b] = []
            left[a], right[a] = min(left[a], left[b]), max(right[a], right[b])
            depth[a], edges[a], least[a] = d, merges, min(least[a], least[b])
        close(find(0), -1)
        self.left, self.right, self.above, self.depth, self.edges, self.least = np.array(done, np.int64).T
        self.parent = np.array(parent)


_NODES = (
    "start int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends binary, parent_start int, parent_conv_id long"
)


def _forest(borders: dict[int, tuple[int, int]]):
    """The nodes of one partition's rows, and pieces of those that reach over its borders.

    A piece has the partition where its node begins as ``start``; its numbers are sums over its own
    rows. ``parent_start`` says so of the parent, ``parent_conv_id`` is there if the parent is whole.
    """
    parts = list(borders)
    place = {part: i for i, part in enumerate(parts)}

    def begin(part: int, depth: int) -> int:
        """Where the node of that depth begins that goes on in ``part`` from the one before."""
        i = place[part] - 1
        while min(borders[parts[i]]) >= depth:
            i -= 1
        return parts[i]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        part = table.column("part")[0].as_py()
        length, lcp, ids, n = (table.column(c).to_numpy().astype(np.int64) for c in ("len", "lcp", "conv_id", "n"))
        lcp[0] = borders[part][0]
        after = parts[place[part] + 1 :][:1]
        reach_left, reach_right, last = int(lcp[0]), borders[after[0]][0] if after else -1, len(n) - 1

        words = table.column("words").combine_chunks().flatten().to_numpy().astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(words)])
        first = np.cumsum(length) - length

        def words_of(row: np.ndarray, turns: np.ndarray) -> np.ndarray:
            return upto[first[row] + np.maximum(turns, 0)] - upto[first[row]]

        def sums(x: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(x)])

        rows = np.arange(len(n))
        whole, shared = words_of(rows, length), words_of(rows, lcp)
        childless = np.append(lcp[1:], reach_right) < length
        members, leaves, saved = sums(n), sums(childless), sums(n * whole - (whole - shared))

        c = Components(lcp, length, ids)
        chain = c.depth - c.above
        own = np.repeat(np.arange(len(chain)), chain)
        d = np.arange(len(own)) - np.repeat(np.cumsum(chain) - chain, chain) + c.above[own] + 1
        left, right = c.left[own], c.right[own]

        def starts(left: np.ndarray, right: np.ndarray, depth: np.ndarray) -> np.ndarray:
            """Where the nodes begin that are not whole here; -1 for those that are."""
            from_left = (left == 0) & (depth <= reach_left) & (depth >= 0)
            out = np.where((right == last) & (depth <= reach_right) & (depth >= 0), part, -1)
            for x in np.unique(depth[from_left]).tolist():
                out[from_left & (depth == x)] = begin(part, x)
            return out

        start = starts(left, right, d)
        from_left = (left == 0) & (d <= reach_left)
        begins = np.where(from_left, lcp[left] == d, length[left] > d)  # the first row, its own child
        children = np.where(d == c.depth[own], c.edges[own], 0) + begins
        before = words_of(left, d - 1)
        count = members[right + 1] - members[left]
        gain = saved[right + 1] - saved[left] - count * before + np.where(from_left, 0, before - shared[left])
        up = np.where(d - 1 > c.above[own], own, c.parent[own])
        up_start = starts(c.left[up], c.right[up], d - 1)
        ends = np.where(length[left] == d, left, -1)

        def known(values: np.ndarray, good: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.array(values, kind, mask=~good)

        digest = table.column("ends").combine_chunks().take(known(ends, ends >= 0, pa.int64()))
        columns = [
            known(start, start >= 0, pa.int32()), pa.array(d, pa.int32()), pa.array(c.least[own]), pa.array(count),
            pa.array(children.astype(np.int64)), pa.array(leaves[right + 1] - leaves[left]), pa.array(gain), digest,
            known(up_start, up_start >= 0, pa.int32()), known(c.least[up], (up_start < 0) & (d > 0), pa.int64()),
        ]
        return pa.Table.from_arrays(columns, [x.split()[0] for x in _NODES.split(", ")])

    return run


def _merged(nodes: DataFrame) -> DataFrame:
    """Whole nodes and, summed up, those in pieces; every one with its parent's conv_id."""
    pieces = nodes.filter("start is not null").groupBy("start", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"), F.max("parent_start").alias("parent_start"),
        F.max("parent_conv_id").alias("parent_conv_id"),
    )
    pieces = written(pieces, "trie-merged")
    above = pieces.select(
        F.col("start").alias("parent_start"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above_id")
    )
    every = nodes.filter("start is null").unionByName(pieces)
    every = every.join(sent_if_small(above), ["parent_start", "depth"], "left")
    return every.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_id")).drop(
        "above_id", "start", "parent_start"
    )


def id_list_hashes(members: DataFrame) -> DataFrame:
    """(ends, sha) of ``members(ends, conv_id)``: SHA-256 of a group's ids in order, comma-joined.

    Ids are sorted over all partitions and packed into texts where they are; only these meet, and
    are hashed as they pass by. A hash of one group is one sequence, but no task holds a group.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, int, list[str]]] = []
            size = 0
            for ends, conv_id in zip(batch.column("ends").to_pylist(), batch.column("conv_id").to_pylist()):
                if not out or out[-1][0] != ends or size > ID_BYTES:
                    out.append((ends, conv_id, []))
                    size = 0
                out[-1][2].append(str(conv_id))
                size += 21
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                    pa.array([",".join(x[2]) for x in out], pa.string()),
                ],
                ["ends", "first", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None
        for batch in batches:
            out = []
            for ends, ids in zip(batch.column("ends").to_pylist(), batch.column("ids").to_pylist()):
                if ends != current:
                    if sha is not None:
                        out.append((current, sha.hexdigest()))
                    current, sha = ends, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["ends", "sha"]
            )
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([sha.hexdigest()])], ["ends", "sha"])

    packed = (
        members.select("ends", "conv_id")
        .repartitionByRange("ends", "conv_id").sortWithinPartitions("ends", "conv_id")
        .mapInArrow(pack, "ends binary, first long, ids string")
    )
    return (
        packed.repartition("ends").sortWithinPartitions("ends", "first").select("ends", "ids")
        .mapInArrow(digest, "ends binary, sha string")
    )


def prefix_trie(sequences: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per trie node of ``sequences(conv_id, seq, words)``, as ``branched_turns`` gives them.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. A sequence without turns is a member of the root
    only. conv_ids are unique and not null. An empty table has no nodes, not even a root.
    ``partitions`` cuts the sorted rows; left out, Spark does so by size.
    """
    distinct = sequences.groupBy("seq").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("words").alias("words")
    )
    by = [partitions, "seq"] if partitions else ["seq"]
    rows = distinct.repartitionByRange(*by).sortWithinPartitions("seq").select("seq", "conv_id", "n", "words")
    rows = written(rows.mapInArrow(_neighbours, _SORTED), "trie-sorted")
    borders = _borders(rows)
    forest = rows.drop("edge").groupBy("part").applyInArrow(_forest(borders), _NODES)
    nodes = _merged(written(forest, "trie-forest"))
    hashes = id_list_hashes(sequences.select(F.unhex(F.md5("seq")).alias("ends"), "conv_id"))
    return nodes.join(hashes, "ends", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, every: int = 20) -> DataFrame:
    """The prefix trie of ``conversations(conv_id, turn, role, text)``, branched every ``every`` ids.

    See ``branched_turns`` for what becomes of nulls, ties and repeated rows, and ``prefix_trie``
    for the result. Very long texts pass as digests; columns of other names are ignored.
    """
    return prefix_trie(written(branched_turns(conversations, every), "trie-sequences"))
