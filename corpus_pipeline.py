"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, mixing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and returns a DataFrame; all but
the last return the columns of ``docs``.  ``run`` writes every stage's rows as Parquet in the shared folder and
reads them back for the next one.

A null text is an empty document; rows with a null ``doc_id`` are documents like any other; rows that repeat an id and
a text are one document, of which near-duplicate removal keeps one row.  Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.llm import curriculum, decontam, pii, qda, simhash
from tokenweave.llm.common import materialise, table
from tokenweave.llm.queries import QUALITY_THRESHOLD, SIMHASH_RADIUS, SIMHASH_SHINGLE

ORACLE_SQL = None  # trained scores and fingerprints have no SQL form; tests/llm compares with brute force


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts; it learns from all labelled ones."""
    model = qda.fit(qda.document_statistics(docs), table(spark, sf_dir, "labels"))
    return docs.where(qda.score_column(model, F.col("text")) >= QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, SIMHASH_SHINGLE, SIMHASH_RADIUS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    found = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"), out_col="_leaks")
    return found.where(F.size("_leaks") == 0).drop("_leaks")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; ``n_chars`` follows the text."""
    chars = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    return pii.redact(docs).withColumn("n_chars", chars).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order."""
    mixed = curriculum.mix(docs.select("doc_id", "text", "source"))
    return curriculum.training_order(mixed.select("doc_id", "source", *curriculum.OUT))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages),
          ("personal_data", personal_data), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
