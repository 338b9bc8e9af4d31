"""The corpus pipeline: quality rules, near-dedup, substring dedup, benchmark decontamination, packing.

Each stage takes the documents its predecessor kept and calls one operator; what it decides takes effect. All but the last
return the columns of documents. Stages hand on tables that are written: a stage deletes what others left of intermediate
tables, except where its documents are read from them. Null ids, texts and other columns, empty or very long texts, equal
rows, columns of any further name and empty tables have the results that the docstrings of the operators state.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import decontaminate, near_dedup, packing, paragraph_dedup, quality
from reelstat.llm.scratch import clear_but, save


def stage(function):
    """A stage whose predecessor's result has been written: the predecessor's intermediate tables go when it begins."""

    @wraps(function)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear_but(docs)
        return function(spark, docs, sf_dir)

    return begun


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


@stage
def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return near_dedup.keep_one(docs)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay in the document of the smallest id and leave all others; n_chars follows the text."""
    kept = paragraph_dedup.remove_passages(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(kept.schema["n_chars"].dataType))
    return kept


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and where they lie in the training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Estimation, components and packing are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = save(step(spark, docs, sf_dir))
    return docs
