"""What a layer has processed, and what its next batch is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.schemas import KEY_DAY


def rows_after(df: DataFrame, low: Column | None, high: Column | None = None) -> DataFrame:
    """Rows ingested after ``low`` (all without one) and up to ``high``.

    The bare column is compared with constants, so both bounds reach the Parquet scan.
    """
    if low is not None:
        df = df.where(F.col("ingested_at") > low)
    if high is not None:
        df = df.where(F.col("ingested_at") <= high)
    return df


def batch_bounds(df: DataFrame, *by: str) -> DataFrame:
    """How many rows a batch has and the newest ingest time: one row (NULL time if empty), or one for
    each value of ``by`` that it holds."""
    return df.groupBy(*by).agg(
        F.count("*").alias("batch_rows"), F.max("ingested_at").alias("max_ingested_at")
    )


def days_after(ingests: DataFrame, low: Column | None) -> DataFrame:
    """Storage days that ingests after ``low`` (all without one) have written to, from the log of
    (ingest instant, day). Which files hold those rows, and how old the files are, does not matter."""
    return rows_after(ingests, low).select(KEY_DAY).distinct()


def latest_watermarks(watermarks: DataFrame) -> DataFrame:
    """The newest mark of every layer; equal update times are settled by the higher mark."""
    newest = F.max(F.struct("updated_at", "last_ingestion_timestamp"))
    return watermarks.groupBy("layer_name").agg(newest.alias("newest")).select(
        "layer_name", "newest.last_ingestion_timestamp", "newest.updated_at"
    )
