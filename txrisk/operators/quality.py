"""Batch quality metrics and the gate that reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.schemas import LEVEL_CUTS

CRITICAL = LEVEL_CUTS[-1][1]


def quality_metrics(silver: DataFrame, bronze_count: int | Column) -> DataFrame:
    """One row of batch metrics from one pass over the scored rows.

    ``bronze_count`` is the row count of the unscored batch: a number, or a scalar subquery.
    Rates of an empty batch are 0.0.
    """
    fraud = F.col("is_fraud")
    counts = silver.agg(
        F.count("*").alias("silver_count"),
        F.count_if(fraud.isNull()).alias("null_fraud"),
        F.count_if(F.col("amount") <= 0).alias("nonpositive_amount"),
        F.count_if(~fraud.isin(0, 1)).alias("fraud_out_of_domain"),
        F.count_if(F.col("risk_score").isNull()).alias("missing_score"),
        F.coalesce(F.avg(fraud.cast("double")), F.lit(0.0)).alias("fraud_rate"),
        F.coalesce(
            F.avg((F.coalesce(F.col("risk_level"), F.lit("")) == CRITICAL).cast("double")), F.lit(0.0)
        ).alias("critical_rate"),
    )
    compared = F.lit(bronze_count).cast("bigint")
    return counts.select(
        compared.alias("bronze_count"),
        "silver_count",
        (compared == F.col("silver_count")).alias("counts_match"),
        "null_fraud",
        "nonpositive_amount",
        "fraud_out_of_domain",
        "missing_score",
        "fraud_rate",
        "critical_rate",
    )


def quality_checks(metrics: DataFrame) -> DataFrame:
    """One row per check: ``check_name, observed, blocking, passed``.

    A blocking check counts bad rows and passes at zero; the rates are for information.
    """
    blocking = {
        "count_mismatch": F.abs(F.col("bronze_count") - F.col("silver_count")),
        "null_fraud": F.col("null_fraud"),
        "nonpositive_amount": F.col("nonpositive_amount"),
        "fraud_out_of_domain": F.col("fraud_out_of_domain"),
        "missing_score": F.col("missing_score"),
    }
    observed_only = {name: F.col(name) for name in ("fraud_rate", "critical_rate")}
    checks = [
        F.struct(
            F.lit(name).alias("check_name"),
            value.cast("double").alias("observed"),
            F.lit(name in blocking).alias("blocking"),
            (F.lit(True) if name in observed_only else value == 0).alias("passed"),
        )
        for name, value in (blocking | observed_only).items()
    ]
    return metrics.select(F.inline(F.array(*checks)))
