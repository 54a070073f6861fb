"""The subpackage's queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat, gif, hard_negatives, langid, lm_bloom, mixing, packing, quality, simhash, substring_dedup, token_files, toxicity, whitening
from .common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_gif_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.op2(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.op3(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op4(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op5(table(spark, sf_dir, "conversations"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op6(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_bloom.scored(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op9(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op10(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.op11(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.op12(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op13(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = (
    op1_packing, op2_gif_columns, op3_substring_dedup, op4_language_id, op5_chat_formatting, op6_token_files, op7_lm_scoring,
    op8_quality_rules, op9_mixing_sources, op10_simhash_near_dedup, op11_hard_negatives, op12_whitening, op13_toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_formatting": chat.SQL, "op11_hard_negatives": hard_negatives.SQL}
