"""A corpus pipeline from raw documents to token ids: each stage applies one operator to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import line_dedup, mixing, ngram_join, piece_coding, toxicity
from harrow.llm.common import shared_dir, small_batches, written

#: The n-gram join's size of shingles and percentage of likeness for near duplicates, and how often a source may be repeated.
WORDS, PERCENT, MAX_EPOCHS = 5, 80, 1.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.score_of(F.col("text"), model) < 0.5)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of two lines or more that stood before go, and documents of which nothing is left."""
    small_batches(spark)
    kept = line_dedup.remove_passages(docs, "_removed").filter("_removed = 0 OR length(text) > 0")
    return kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    small_batches(spark)
    groups = ngram_join.similar_groups(docs, WORDS, PERCENT)
    return docs.join(groups.filter("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to MAX_EPOCHS times, so that source weights come as near to each other as that allows; no document is left out."""
    small_batches(spark)
    return mixing.mix(docs, budget=None, max_epochs=MAX_EPOCHS, places=False)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, each decoded again to the digest of its text."""
    small_batches(spark)
    return piece_coding.encode(docs, keep=["doc_id", "lang", "source"], check=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: The first and last stages can't be expressed in SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet in the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{k}")
    return docs
