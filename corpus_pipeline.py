"""From raw documents to packed sequences: five operators of ``anchorline.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents.

All stages: an empty table gives an empty one, with the same columns up to the last
stage; columns other than doc_id, source and text may hold nulls, have any name and
pass through; very long texts are taken whole.  What nulls and repeated rows get is
said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from anchorline.llm import common, mixing, packing, quality, simhash, substring_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the plain rules or the log-likelihood ratio reject; null texts go, repeated rows stay or go together."""
    return quality.filtered(docs, common.table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of copies and near copies; repeated rows are copies, null and blank texts one group, of ids the least stays and a null one only beside no other."""
    return simhash.survivors(docs)


def sentence_span_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes sentences under repeated spans, and documents of which nothing is left; null texts stay, repeated rows are one document."""
    return substring_dedup.deduplicated(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that the sources meet their targets; null texts have no words and go, a null source is one of its own, repeated rows are taken equally often."""
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens; null texts have their end id, repeated rows are packed each for itself; the workers, which serve all stages, remember fewer pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached=150_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", sentence_span_dedup),
    ("mixing", mixing_to_targets),
    ("packing", packed_sequences),
]

#: Hashing, token ids and random rounding have no SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.on_workers(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
