"""Bronze to scored Silver rows: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rules import (
    Thresholds,
    balance_ratios,
    risk_level,
    risk_score,
    rule_flags,
    time_features,
)


def with_features(df: DataFrame) -> DataFrame:
    return df.withColumns(time_features() | balance_ratios())


def with_flags(df: DataFrame, limits: Thresholds) -> DataFrame:
    return df.withColumns(rule_flags(limits))


def with_score(df: DataFrame, limits: Thresholds) -> DataFrame:
    """Flags, their sum and the level the sum falls into."""
    score = risk_score(list(rule_flags(limits)))
    return with_flags(df, limits).withColumns({"risk_score": score, "risk_level": risk_level(score)})


def to_silver(df: DataFrame, limits: Thresholds) -> DataFrame:
    """All derived columns and the version of the limits that scored the row."""
    return with_score(with_features(df), limits).withColumn("threshold_version", F.lit(limits.version))
