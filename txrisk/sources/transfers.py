"""Transfers derived from the sample star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def transfers(spark: SparkSession, directory: str) -> DataFrame:
    """One raw transfer per event: the user pays, a supplier is paid, balances are theirs.

    Payers grow with the events, and their file says little of their size in memory, so they are joined by
    a shuffle and never sent to the driver.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}.parquet")

    payer = table("customer").select("c_custkey", "c_acctbal")
    payee = table("supplier").select("s_suppkey", "s_acctbal")
    payees = table("supplier").select(F.count("*")).scalar()
    events = table("events").withColumn("payee", F.col("event_id") % payees)
    return (
        events.join(payer.hint("merge"), F.col("user_id") == F.col("c_custkey"))
        .join(payee, F.col("payee") == F.col("s_suppkey"))
        .select(
            F.col("user_id").cast("string").alias("payer_id"),
            F.col("s_suppkey").cast("string").alias("payee_id"),
            F.col("event_type").alias("tx_type"),
            F.col("value").alias("amount"),
            F.col("c_acctbal").alias("payer_balance_before"),
            (F.col("c_acctbal") - F.col("value")).alias("payer_balance_after"),
            F.col("s_acctbal").alias("payee_balance_before"),
            (F.col("s_acctbal") + F.col("value")).alias("payee_balance_after"),
            F.col("ts").alias("event_time"),
            (F.col("event_type") == "error").cast("int").cast("double").alias("is_fraud"),
        )
    )
