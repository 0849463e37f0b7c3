"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shoptrail.llm import conversations, decontaminate, kneserney, licences, linededup, minhash, mixing, quality, runs, simhash
from shoptrail.llm import tokencount, topk, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.query(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.query(_table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.query(_table(spark, folder, "documents"))


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return kneserney.query(_table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.query(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.query(_table(spark, folder, "embeddings"))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.query(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.query(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.query(_table(spark, folder, "documents"))


def op10_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.query(_table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.query(_table(spark, folder, "documents"))


def op12_repair_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.query(_table(spark, folder, "conversations"))


def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.query(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = {name: f for name, f in globals().items() if name.startswith("op")}
    return operators | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": decontaminate.SQL,
        "op6_top_k_search": topk.SQL,
        "op9_line_dedup": linededup.SQL,
        "op10_licence_scan": licences.SQL,
        "op13_minhash_near_dedup": minhash.SQL,
    }
