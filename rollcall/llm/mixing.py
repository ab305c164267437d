"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a budget of words, its target. Whole epochs of a source come first; what is
left of the budget goes to documents in the order of their exponential keys ``-ln(u) / weight``,
smallest first, up to the one at which the running total comes nearest to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, written

#: Keys are counted in bins, each wider than the last by one part in so many; only one bin of a source is
#: ever sorted. Whatever the weights, it holds less than 1 / (e * STEPS) of the source's keys, by expectation.
STEPS = 2048


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for text without ``#*$%&|<>``, less the more of them it holds; 1 for null."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * share), F.lit(1.0))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: str) -> Column:
    """``-ln(u) / weight`` with u in (0, 1] from a digest, so that reruns agree."""
    name = F.concat_ws(
        ":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))
    )
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")
    u = (bits.cast("double") + 1.0) / F.lit(float(2**52))
    return -F.log(u) / weight


def _bin(key: Column) -> Column:
    """The bin of a key. Bins are even on a logarithmic scale: weights scale keys, and only shift them there."""
    return F.floor(F.log(F.greatest(key, F.lit(1e-300))) * STEPS)


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3
) -> DataFrame:
    """(source, source_size, target) from ``totals(source, source_size)``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes.
    A target stops at ``max_epochs`` times its source; the excess goes to the others by weight.
    Sources in order of size per weight: the first that its share doesn't fill ends the stops.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % n + 1)
    ranked = totals.select(
        "source", "source_size", weight.alias("w"), (F.col("source_size") * max_epochs).alias("cap")
    )
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stopped = ranked.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .alias("left"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .alias("w_left"),
    ).withColumn("stops", F.col("cap") * F.col("w_left") < F.col("left") * F.col("w"))
    size_left = F.sum("source_size").over(everything) - F.sum(
        F.when(F.col("stops"), F.col("cap")).otherwise(0)
    ).over(everything)
    w_left = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("w"))).over(everything)
    share = F.col("w").cast("double") * size_left.cast("double") / w_left.cast("double")
    return stopped.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    size: str = "size",
    key: str = "key",
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``taken`` (columns of those names give way).

    ``size`` and ``key`` are columns of ``docs``: words, and the sampling key. ``taken`` is
    the document's words times the epochs in which it is used. Within a source, rows of one
    key (repeated rows) are taken or left together. A null source is a source of its own; a null
    size counts as 0; an empty table stays empty. Tables of one row per source, and of one row
    per source and bin, pass through windows; documents do so for one bin of a source only.
    """
    out = [c for c in docs.columns if c not in ("source_size", "target", "taken")]
    rows = docs.select(
        F.col(source).alias("source"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n"),
        F.col(key).alias("k"),
        _bin(F.col(key)).alias("bin"),
    )
    bins = written(rows.groupBy("source", "bin").agg(F.sum("n").alias("n")), "mix-bins")
    totals = bins.groupBy("source").agg(F.sum("n").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    goals = written(
        source_targets(totals, weights, max_epochs)
        .withColumn("epochs", F.coalesce(epochs, F.lit(0)))
        .withColumn("rest", rest),
        "mix-goals",
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])

    edge = (
        bins.join(goals, same(bins, goals))
        .select(
            goals["source"],
            "bin",
            "rest",
            (F.sum("n").over(Window.partitionBy(goals["source"]).orderBy("bin")) - F.col("n"))
            .alias("before"),
            "n",
        )
        .filter("before <= rest and rest < before + n")
        .select(F.col("source").alias("s"), F.col("bin").alias("b"), "rest", "before")
    )
    in_edge = rows.join(
        F.broadcast(edge) if _small(edge) else edge,
        rows["source"].eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")),
    )
    peers = in_edge.groupBy("source", "rest", "before", "k").agg(F.sum("n").alias("n"))
    by_key = Window.partitionBy("source").orderBy("k")
    middle = F.col("before") + F.sum("n").over(by_key) - F.col("n") / 2
    cut = (
        peers.withColumn("middle", middle)
        .filter("middle <= rest")
        .groupBy("source").agg(F.max("k").alias("cut_in_edge"))
        .withColumnRenamed("source", "s")
    )
    ends = edge.select("s", "b").join(
        cut.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left"
    )
    plan = written(
        goals.join(ends, goals["source"].eqNullSafe(F.col("s")), "left").select(
            goals["source"].alias("mix_source"),
            "source_size",
            "target",
            F.col("epochs").alias("mix_epochs"),
            F.col("rest").alias("mix_rest"),
            F.col("b").alias("mix_bin"),
            F.col("cut_in_edge").alias("mix_cut"),
        ),
        "mix-plan",
    )
    kept = docs.select(*out)
    row_bin = _bin(F.col(key))
    extra = F.when(
        F.col("mix_bin").isNull(), F.col("mix_rest") >= F.col("source_size")
    ).otherwise((row_bin < F.col("mix_bin")) | (F.col(key) <= F.coalesce("mix_cut", F.lit(-1.0))))
    taken = F.coalesce(F.col(size), F.lit(0)).cast("long") * (
        F.col("mix_epochs") + F.coalesce(extra, F.lit(False)).cast("long")
    )
    return kept.join(plan, kept[source].eqNullSafe(plan["mix_source"])).select(
        *[kept[c] for c in out], "source_size", "target", taken.cast("long").alias("taken")
    )


def _small(edge: DataFrame) -> bool:
    """One row per source: counted before it is sent to every task."""
    return edge.count() <= 100_000
