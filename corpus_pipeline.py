"""A training corpus from raw documents: each stage applies one operator to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orelake.llm import exact_dedup, mixing, near_dedup, piece_sampling, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies one document stays."""
    return near_dedup.keep(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domains ask for."""
    return mixing.mix(docs, mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text; they decode to it."""
    return piece_sampling.encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("mixing", mixed),
    ("sentencepiece", pieces),
]

# Minhash groups and sampled segmentations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
