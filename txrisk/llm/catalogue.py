"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations,
    decontaminate,
    lines,
    mixing,
    near_dup,
    pii,
    quality,
    sharding,
    substrings,
    tokens,
    toxicity,
    warc,
    whitening,
)
from .oracles import ORACLES
from .shared import table

__all__ = ["ORACLES", "QUERIES"]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op4_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a plain table scan has the same parts in every pass
    return substrings.digest(
        substrings.without_repeats(table(spark, sf_dir, "documents"), copy=False)
    )


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenised(
        table(spark, sf_dir, "documents"), public_tokenizers.path(tokens.VOCABULARY)
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, no source more than twice: the hot source gives way."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.Target(max_passes=2.0, budget=mixing.total_tokens(docs)))
    return mixed.select("row.doc_id", "source", "tokens", "pass", "block", "before")


def op9_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.digest(lines.without_shared_lines(docs))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_members": op2_warc_members,
    "op3_personal_data": op3_personal_data,
    "op4_hash_shards": op4_hash_shards,
    "op5_repeated_substrings": op5_repeated_substrings,
    "op6_token_binary": op6_token_binary,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_source_mixing": op8_source_mixing,
    "op9_benchmark_matches": op9_benchmark_matches,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_line_dedup": op13_line_dedup,
}
