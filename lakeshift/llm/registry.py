"""Queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm import (
    brown_lm,
    chat_format,
    crf_pii,
    digest_dedup,
    extendible_sharding,
    merkle_manifest,
    order_minhash,
    overlap_tokens,
    quality_bayes,
    secret_scan,
    source_mixing,
    spaced_decontam,
    turn_repair,
)
from lakeshift.llm.common import table

#: Bytes of text in a shard at most.
SHARD_BYTES = 16 << 20


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.lm_scores(table(spark, sf_dir, "documents"))


def op2_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_pii.personal_data(table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_overlap_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_tokens.token_counts(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixed(table(spark, sf_dir, "documents"))


def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_sharding.shard_ids(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat_format.chat_digests(chat_format.with_test_conversation(turns))


def op9_spaced_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bayes.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), *quality_bayes.source_site())


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.structure_repairs(table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_brown_lm,
        op2_crf_pii,
        op3_order_minhash,
        op4_overlap_tokens,
        op5_exact_dedup,
        op6_source_mixing,
        op7_extendible_sharding,
        op8_chat_format,
        op9_spaced_decontam,
        op10_quality_bayes,
        op11_turn_repair,
        op12_secret_scan,
        op13_merkle_manifest,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_dedup": digest_dedup.ORACLE,
        "op6_source_mixing": source_mixing.ORACLE,
        "op8_chat_format": chat_format.ORACLE,
        "op12_secret_scan": secret_scan.ORACLE,
        "op13_merkle_manifest": merkle_manifest.ORACLE,
    }
