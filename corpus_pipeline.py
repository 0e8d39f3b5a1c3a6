"""From raw documents to token ids: quality filter, near-duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table with the columns of documents; the last adds the token ids.
Stages work on whole tables. Rows without an id are documents like others: they are filtered by their text alone, and take
no part in groups of near-duplicates. An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.llm import bpe, leaks, near, quality, repeats
from tasklens.llm.queries import read, vocabulary


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learnt from ``labels`` and the documents at hand, does not reject."""
    weights = quality.train_quality(docs, read(spark, sf_dir, "labels"))
    # Under other names, as the table may have columns called like the score.
    names = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    scored = quality.score_quality(docs.select(*[F.col(c).alias(n) for c, n in names.items()]), weights, names["text"])
    return scored.filter("predicted = 1").select(*[F.col(n).alias(c) for c, n in names.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id: five-word shingles, Jaccard 0.8."""
    groups = near.near_components(docs, shingle=5, percent=80)
    others = groups.filter("id <> component_id").select(F.col("id").alias("_dropped")).distinct()
    return docs.join(others, docs["doc_id"] == others["_dropped"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages of twenty and more words that another, or they themselves, held before.

    ``n_chars`` follows the text where it changed; a document that loses all its words stays as an empty one.
    """
    cut = repeats.remove_repeats(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    columns = [changed.cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cut.select(*columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of ``benchmark``."""
    found = leaks.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    held = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(held["_id"]) & (F.xxhash64(docs["text"]) == held["_key"])
    return docs.join(held, same, "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the token ids and their number, and the texts that the ids decode to."""
    path, pattern = vocabulary()
    return bpe.round_trip(docs.select("doc_id", "text"), path, pattern, keep_text=False)


STAGES = [
    ("quality_classifier", quality_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("byte_bpe", token_ids),
]

# Hashed features, shingles and seeds have no form in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
