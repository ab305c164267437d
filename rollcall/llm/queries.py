"""Registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .cotraining import learn_quality, quality_scores
from .decontaminate import find_contaminated
from .language import language_of, language_samples
from .licenses import learn_licenses, license_notices
from .lines import drop_repeated
from .minhash import near_duplicates
from .mixing import mix_sources, quality_weight, sampling_key, words_in
from .negatives import hard_negatives, whole_vectors
from .quality import language_references, quality_verdict
from .simhash import simhash_duplicates
from .toxicity import learn_toxicity, toxicity_score
from .trie import conversation_trie
from .warc import archive_folder, read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_contaminated(docs, table(spark, sf_dir, "benchmark"))


def op2_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by two views that taught one another."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    model = spark.sparkContext.broadcast(learn_quality(docs, table(spark, sf_dir, "labels")))
    scores = quality_scores(*(F.col(c) for c in ("text", "source", "lang", "n_chars")), model)
    return docs.select("doc_id", scores.alias("q")).select(
        "doc_id", "q.text_score", "q.meta_score", "q.score", (F.col("q.score") >= 0.5).alias("kept")
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets are 80 percent alike."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back; fails if an archive cannot be read to its end."""
    archives = write_warc(table(spark, sf_dir, "pages"), archive_folder(spark))
    page = F.when(F.col("error").isNotNull(), F.raise_error("error").cast("long")).otherwise(F.col("page_id"))
    return read_warc(spark, archives, payload=False).select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, nearly or exactly."""
    return drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    verdict = quality_verdict(F.col("text"), language_references(docs))
    return docs.select("doc_id", verdict.alias("q")).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
        "q.base_failed", "q.kept",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = spark.sparkContext.broadcast(learn_toxicity(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity_score(F.col("text"), model).alias("score")
    )
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in any paragraph of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_notices(docs, spark.sparkContext.broadcast(learn_licenses(docs)))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents")
    key = sampling_key(F.col("doc_id"), F.col("text"), quality_weight(F.col("text")), "mix-1")
    sized = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), key.alias("key"))
    return mix_sources(written(sized, "mix-sizes")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = spark.sparkContext.broadcast({"samples": language_samples(docs)})
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return docs.select(
        "doc_id", held_out.alias("held_out"), language_of(F.col("text"), model).alias("l")
    ).select("doc_id", "held_out", "l.lang_pred", "l.score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, over vectors of which every seventh is relabelled."""
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations, branched off every twentieth."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in two bits at most."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_cotrained_quality,
        op3_near_duplicates,
        op4_warc,
        op5_line_dedup,
        op6_quality_rules,
        op7_toxicity,
        op8_license_notices,
        op9_mix_sources,
        op10_language_id,
        op11_hard_negatives,
        op12_prefix_trie,
        op13_simhash_duplicates,
    )
}
