"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import (
    collocations,
    filter_audit,
    language,
    licenses,
    mixing,
    packing,
    preferences,
    quality_rules,
    simhash,
    suffix_dedup,
    token_blocks,
    top_k,
    toxicity,
)
from arrears.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with one answer cut short."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return preferences.preference_pairs(turns, preferences.degraded(turns))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.grade(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_classes(read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return classes.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_blocks.written_and_read(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_preference_formatting": op1_preference_formatting,
        "op2_quality_rules": op2_quality_rules,
        "op3_simhash": op3_simhash,
        "op4_packing": op4_packing,
        "op5_licenses": op5_licenses,
        "op6_language": op6_language,
        "op7_top_k": op7_top_k,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_toxicity": op9_toxicity,
        "op10_mixing": op10_mixing,
        "op11_collocations": op11_collocations,
        "op12_token_blocks": op12_token_blocks,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_preference_formatting": preferences.ORACLE,
        "op7_top_k": top_k.ORACLE,
        "op8_suffix_dedup": suffix_dedup.ORACLE,
        "op11_collocations": collocations.ORACLE,
        "op13_filter_audit": filter_audit.ORACLE,
    }
