"""The corpus pipeline: reject, deduplicate, decontaminate, mix and shard ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import decontaminate, mixing, quality, sharding, simhash
from tallyworks.llm.common import table
from tallyworks.session import settle

SHARDS = 40


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", reject_bad),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", deal_shards),
]

# A trained classifier and SimHash have no SQL form: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
