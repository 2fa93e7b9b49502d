"""The corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and but for
the last returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import forest, packing, quality, secrets, suffixes
from headway.llm.stage import small_batches
from headway.sources.shared import shared_folder


def _counted(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the fixed limits nor the learned rules reject."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies."""
    return forest.one_of_each(docs)


# Length of the strings that repeated_passages looks for, in bytes: hardly any 51 words of prose are
# shorter, and every byte of a passage that occurs again is in such a string of it.
PASSAGE_BYTES = 240


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of PASSAGE_BYTES that occur again; no row goes."""
    return _counted(suffixes.strip_repeats(docs, PASSAGE_BYTES))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret; no row goes."""
    return _counted(secrets.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token pieces, as little-endian unsigned 32-bit ids, and where they lie in the
    packed sequences."""
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed_pieces(
        pieces.select("doc_id", "piece", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"))
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]
# Learned rules, similarity classes, byte strings and token ids are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        with small_batches(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
