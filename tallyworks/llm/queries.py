"""The registered queries: each applies one operator to its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import (
    chat,
    collocations,
    decontaminate,
    divergence,
    imatch,
    langid,
    licenses,
    mixing,
    quality,
    repeats,
    secrets,
    sharding,
    simhash,
)
from tallyworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


def op2_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op3_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(table(spark, folder, "documents"), SHARDS)


def op4_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprint_report(table(spark, folder, "documents"))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_report(table(spark, folder, "documents"))


def op6_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, folder, "documents"))


def op7_crf_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(table(spark, folder, "documents"))


def op8_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"))


def op9_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_report(table(spark, folder, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence_report(table(spark, folder, "documents"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocation_report(table(spark, folder, "documents"))


def op13_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_license_scan,
            op2_chat_snapshots,
            op3_jump_sharding,
            op4_imatch_fingerprints,
            op5_source_mixing,
            op6_simhash_near_duplicates,
            op7_crf_secrets,
            op8_weak_label_quality,
            op9_ppm_language,
            op10_benchmark_decontamination,
            op11_source_divergence,
            op12_phrase_collocations,
            op13_suffix_array_dedup,
        )
    }
