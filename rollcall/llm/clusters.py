"""Exact links inside clusters of candidates, without lists of pairs.

A cluster of up to ``BLOCK`` members is compared as a whole, in one group of rows. A larger one
is dealt into blocks; each block is compared in itself and with a few members of the cluster
that visit all blocks; then only members that are not in the cluster's largest component yet
visit the other blocks. A group hands on the links that connect it, fewer than it has members.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .components import connected_components

BLOCK = 128
#: Members of a large cluster that visit all its blocks in the first round.
VISITORS = 8
#: Node lists up to this length are sent to all tasks; longer ones are joined by shuffling.
BROADCAST_ROWS = 500_000
#: Node lists up to this length (6 MB in memory) are sent to the tasks that read texts; longer ones meet by shuffling.
SENT_NODES = 50_000
#: A sieve has so many rows at most, of so many words of 64 bits: 33 million bits, some 7 MB for any number of nodes.
SIEVE_ROWS = 1 << 16
SIEVE_WORDS = 8


def sent_if_small(nodes: DataFrame) -> DataFrame:
    """``nodes`` (narrow rows), marked for broadcast if counted to be few."""
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes


def _place(node: Column) -> tuple[Column, Column, Column]:
    """Row, word and bit of a node in a sieve."""
    h = F.xxhash64(node.cast("long"))
    word = F.pmod(F.shiftright(h, 32), F.lit(SIEVE_WORDS)).cast("int")
    return F.pmod(h, F.lit(SIEVE_ROWS)), word, F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(63)).cast("int")


def _sieve(nodes: DataFrame) -> DataFrame:
    """(row, words): the bits of all ``nodes(node)``. Other nodes share a bit with one of them by chance only."""
    row, word, bit = _place(F.col("node"))
    at = nodes.select(row.alias("row"), word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("bit"))), F.lit(0).cast("long")) for i in range(SIEVE_WORDS)]
    return at.groupBy("row").agg(F.array(*words).alias("words"))


def rows_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (wide, with ``node``) joined with ``nodes`` (narrow) on ``node``.

    What the driver holds does not grow with the nodes: a short list is sent to all tasks; of a long
    one only a sieve is, and the rows that pass it, little more than those wanted, meet it by shuffling.
    """
    if nodes.count() <= SENT_NODES:
        return rows.join(F.broadcast(nodes), "node")
    row, word, bit = _place(F.col("node"))
    held = F.call_function("shiftrightunsigned", F.get("words", word), bit).bitwiseAND(F.lit(1).cast("long"))
    passed = rows.withColumn("row", row).join(F.broadcast(_sieve(nodes)), "row").filter(held == 1)
    return passed.drop("row", "words").join(nodes.hint("merge"), "node")


def links_within(clusters: DataFrame, confirm: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) that connect what is truly linked in each cluster of ``clusters(node, root)``.

    ``confirm`` gets ``(cluster, block, node, visitor)`` and returns links ``(u, v)`` that
    connect every group of equal cluster and block as all its true links do; links between two
    visitors may be left out, as they meet again in the block where one of them lives.
    """
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    dealt = written(
        clusters.join(sizes, "root")
        .select(F.col("root").alias("cluster"), blocks.alias("blocks"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))),
        "dealt",
    )
    large = dealt.filter("blocks > 1")
    order = Window.partitionBy("cluster").orderBy(F.xxhash64("node", F.lit(1)))
    first = large.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= VISITORS)
    home = dealt.select("cluster", "block", "node", F.lit(False).alias("visitor"))
    links = written(confirm(home.unionByName(_visits(first))), "links")
    if large.isEmpty():
        return links
    joined = connected_components(links)
    parts = large.join(joined, "node", "left").withColumn("part", F.coalesce("root", "node"))
    count = parts.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    top = count.groupBy("cluster").agg(F.max("n").alias("n"))
    main = count.join(top, ["cluster", "n"]).groupBy("cluster").agg(F.min("part").alias("main"))
    left = written(
        parts.join(main, "cluster")
        .filter("part <> main").select("cluster", "block", "blocks", "node"),
        "left",
    )
    if left.isEmpty():
        return links
    home = large.join(left.select("cluster").distinct(), "cluster", "left_semi").select(
        "cluster", "block", "node", F.lit(False).alias("visitor")
    )
    return links.unionByName(written(confirm(home.unionByName(_visits(left))), "links"))


def _visits(nodes: DataFrame) -> DataFrame:
    """Each of ``nodes(cluster, block, blocks, node)`` as a visitor of every block but its own."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("b")
    return (
        nodes.select("cluster", "node", F.col("block").alias("own"), every)
        .filter("b <> own")
        .select("cluster", F.col("b").cast("long").alias("block"), "node", F.lit(True).alias("visitor"))
    )


def spanning_links(nodes: list[int], pairs, linked: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Those of the index pairs that connect what all of them connect.

    With ``linked`` a pair counts only if that says so; it is asked only of pairs that are not
    connected yet.
    """
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b and (linked is None or linked(i, j)):
            root[b] = a
            if nodes[i] != nodes[j]:
                out.append((nodes[i], nodes[j]))
    return out
