"""Training corpus pipeline: documents through the stages below, each stage on what the one before it kept.

Every stage is a function of (spark, docs, sf_dir) and returns the columns of the documents, the last one its packed
pieces. Between stages the documents are written as Parquet in the shared folder and read again,
so a lost executor costs at most the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import jaccard, packing, quality, secrets, substrings
from riskmart.sources.scratch import Staging

SHINGLE, PERCENT = 5, 80  # words, and the similarity from which documents are near copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers in their language and source."""
    return quality.quality_filter(docs, Staging(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return jaccard.without_near_copies(docs, Staging(spark), SHINGLE, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; what has no word left goes."""
    kept = substrings.without_repeats(docs, Staging(spark)).filter("n_words > n_removed")
    return _like(kept, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a label."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each a sequence of a power of two of tokens."""
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)
    return packing.sequences(Staging(spark).table(pieces, "pieces"))


def _like(kept: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*[f"`{c}`" for c in docs.columns])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# Robust fits, redaction and tokenising have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return docs
