"""Corpus pipeline: stages over ``documents``, each written to the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklake.llm import exact_dedup, mixing, near_dedup, packing, quality_model
from clicklake.llm.common import documents
from clicklake.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.accepted(docs, quality_model.learn(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 80 percent."""
    return near_dedup.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]

# The classifier, the sketches and the packing plan cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
