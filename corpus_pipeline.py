"""A corpus made ready for training: rejected, deduplicated three ways, and packed.

Every stage takes (session, documents, folder of the tables) and works on all that the one before
it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, gam, jaccard_join, packing, substring_dedup
from tidemark.session import cut, prepare


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return gam.accepted(docs, gam.fit_scores(docs, labels))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal documents."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of similar documents."""
    return jaccard_join.deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that came before; n_chars is that of the new text."""
    found = substring_dedup.deduplicated(docs)
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, one row per piece."""
    return packing.digests(packing.packed(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("sequences", sequences),
]

# SQL can express neither the classifier nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has written."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
