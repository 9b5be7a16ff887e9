"""A corpus pipeline of five stages, each the written result of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.llm import decontaminate, fm_dedup, jaccard_trees, packing, quality_mil
from quartermark.llm.queries import public_tokenizer
from quartermark.session import shared_dir

# Near duplicates: shingles of five words, and the least share of common ones in percent.
SHINGLE = 5
PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the given documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_mil.keep_good(docs, quality_mil.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return jaccard_trees.keep_first(docs, size=SHINGLE, percent=PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that an earlier document has in the same sequence."""
    return fm_dedup.rewrite(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of equal length."""
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

# A trained network, similarity groups and a tokenizer: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
