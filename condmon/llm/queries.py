"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from condmon.llm import (
    chat,
    convrepair,
    decontam,
    linededup,
    mixing,
    ngramlm,
    oracles,
    quality_rules,
    quality_zstd,
    sharding,
    simhash,
    toxicity,
    unitdedup,
    whitening,
)
from condmon.llm.common import read_table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read_table(spark, sf_dir, "documents"), words=linededup.WORDS)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_totals(read_table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.score_corpus(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_zstd.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_shard_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_plan(read_table(spark, sf_dir, "documents"))


def op10_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unitdedup.dedup_units(read_table(spark, sf_dir, "documents"), whole=True)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return convrepair.repair_report(rows, convrepair.damage(rows))


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_decontaminate": op2_decontaminate,
        "op3_simhash_dedup": op3_simhash_dedup,
        "op4_line_dedup": op4_line_dedup,
        "op5_mix_sources": op5_mix_sources,
        "op6_lm_score": op6_lm_score,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_quality_rules": op8_quality_rules,
        "op9_shard_interleaved": op9_shard_interleaved,
        "op10_unit_dedup": op10_unit_dedup,
        "op11_toxicity": op11_toxicity,
        "op12_repair_conversations": op12_repair_conversations,
        "op13_whiten_embeddings": op13_whiten_embeddings,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": oracles.chat_sql(),
        "op4_line_dedup": oracles.line_dedup_sql(),
        "op5_mix_sources": oracles.mix_sql(),
        "op9_shard_interleaved": oracles.shard_sql(),
        "op12_repair_conversations": oracles.repair_sql(),
    }
