"""Documents from raw to token files, in stages that each call one operator of txrisk.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import decontaminate, mixing, near_dup, tokens, toxicity
from txrisk.llm.shared import stored, table

#: The mixing stage uses every document once; small sources up to this many times.
MAX_PASSES = 1.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. A null text counts as empty, rows with a null or repeated doc_id are
    judged like others; without labels of both classes all scores are one share."""
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, network)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, also of rows that share a doc_id or have none; rows
    without words stay, and an empty table stays empty (see ``near_dup.without_copies``)."""
    return near_dup.without_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold none. Rows are judged one
    by one, whatever their doc_id, and passages with a null item_id count too."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The largest source once, smaller ones up to MAX_PASSES times, by temperature. A null source is a
    source of its own; rows without tokens come once."""
    return mixing.mix(docs, mixing.Target(max_passes=MAX_PASSES)).select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, as the digest read back from them: a row for each use of a document,
    in ascending doc_id order, nulls first; a null text is its end id alone."""
    return tokens.tokenised(docs, public_tokenizers.path(tokens.VOCABULARY))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token ids", token_stage),
]

#: SQL cannot express the trained and the sketching stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
