"""Silver to snapshots and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.schemas import ALERT_SCORE, ALERTS, KEY_DAY

_BY_LEVEL = ("risk_level",)
_BY_TIME = ("is_weekday", "is_night")


def _totals(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("tx_count"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
        F.sum("amount").alias("amount_sum"),
    )


def risk_effectiveness(silver: DataFrame) -> DataFrame:
    """Transfers, frauds and money per risk level. Levels without rows are absent."""
    return _totals(silver, _BY_LEVEL)


def operational(silver: DataFrame) -> DataFrame:
    """Transfers, frauds and money per weekday and night group."""
    return _totals(silver, _BY_TIME)


def daily_totals(silver: DataFrame) -> DataFrame:
    """Totals per storage day, level and time group: at most 54 rows a day, counting NULL groups.

    Both snapshots roll up from it. A row never changes its day, so totals of days without new rows
    stay as they are, and a job only reads the days of its batch.
    """
    return _totals(silver, (KEY_DAY,) + _BY_LEVEL + _BY_TIME)


def _roll_up(base: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return base.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in ("tx_count", "fraud_count", "amount_sum")]
    )


def risk_effectiveness_from(base: DataFrame) -> DataFrame:
    return _roll_up(base, _BY_LEVEL)


def operational_from(base: DataFrame) -> DataFrame:
    return _roll_up(base, _BY_TIME)


def alerts(silver: DataFrame, alert_score: int = ALERT_SCORE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows scoring at least ``alert_score``, cut to the alert columns (then ``keep``)."""
    return silver.where(F.col("risk_score") >= alert_score).select(*ALERTS.names, *keep)
