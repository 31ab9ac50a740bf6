"""Risk rules as Column expressions; nothing here touches a DataFrame."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schemas import (
    LEVEL_BELOW_CUTS,
    LEVEL_CUTS,
    NIGHT_ENDS_AT_HOUR,
    NIGHT_STARTS_AT_HOUR,
    SATURDAY,
    SUNDAY,
)


class Thresholds(NamedTuple):
    """Limits of the amount and ratio rules: numbers in a job, Columns inside one lazy plan."""

    amount: float | Column
    residual_balance_ratio: float | Column
    payee_amount_ratio: float | Column
    version: str | Column


def time_features() -> dict[str, Column]:
    """Hour, day and their groups, read from the wall clock of ``event_time``."""
    hour, day = F.hour("event_time"), F.dayofweek("event_time")
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "is_weekday": ~day.isin(SUNDAY, SATURDAY),
        "is_night": ~hour.between(NIGHT_ENDS_AT_HOUR, NIGHT_STARTS_AT_HOUR - 1),
    }


def ratio_or_zero(part: str, whole: str) -> Column:
    """``part / whole``; 0.0 where ``whole`` is 0 or NULL, NULL where only ``part`` is."""
    base = F.col(whole)
    return F.when(base.isNull() | (base == 0), 0.0).otherwise(F.col(part) / base)


def balance_ratios() -> dict[str, Column]:
    """The two ratios that scoring and calibration share."""
    return {
        "residual_balance_ratio": ratio_or_zero("payer_balance_after", "payer_balance_before"),
        "payee_amount_ratio": ratio_or_zero("amount", "payee_balance_before"),
    }


def rule_flags(limits: Thresholds) -> dict[str, Column]:
    """One 0/1 flag per rule. Limits are strict: a value equal to its limit is not flagged."""
    night = F.col("is_night")
    high_amount = F.col("amount") > F.lit(limits.amount)
    rules = {
        "flag_night": night,
        "flag_night_high_amount": night & high_amount,
        "flag_high_amount": high_amount,
        "flag_residual_balance": F.col("residual_balance_ratio") > F.lit(limits.residual_balance_ratio),
        "flag_payee_ratio": F.col("payee_amount_ratio") > F.lit(limits.payee_amount_ratio),
    }
    return {name: rule.cast("int") for name, rule in rules.items()}


def risk_score(flags: list[str]) -> Column:
    """Number of raised flags; NULL as soon as one flag is NULL."""
    return reduce(add, [F.col(name) for name in flags])


def risk_level(score: Column) -> Column:
    """Name of the highest cut the score reaches."""
    return reduce(
        lambda below, cut: F.when(score >= cut[0], cut[1]).otherwise(below),
        LEVEL_CUTS,
        F.lit(LEVEL_BELOW_CUTS),
    )
