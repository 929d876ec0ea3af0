"""The corpus pipeline: five stages over the documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrears.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from arrears.llm.frames import read
from arrears.sources.scratch import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_first(docs)


def span_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier document go; the documents stay."""
    return suffix_dedup.cleaned(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares of source, language and topic."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_dedup),
    ("suffix_dedup", span_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# Expectation-maximisation, tries, suffix order and a tokenizer are beyond SQL;
# tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
