from datetime import datetime

import pytest
from rows import LIMITS, raw

from txrisk.operators.silver import to_silver, with_features
from txrisk.schemas import SILVER

NIGHT = datetime(2024, 1, 3, 23, 0)


def scored(spark, *changes):
    return to_silver(raw(spark, *changes), LIMITS).collect()


def test_night_is_ten_in_the_evening_to_six(spark):
    hours = [{"event_time": datetime(2024, 1, 3, hour, 59)} for hour in (5, 6, 21, 22)]
    rows = with_features(raw(spark, *hours)).collect()
    assert [(row.hour_of_day, row.is_night) for row in rows] == [
        (5, True),
        (6, False),
        (21, False),
        (22, True),
    ]


def test_weekdays_are_monday_to_friday(spark):
    days = [{"event_time": datetime(2024, 1, day)} for day in (5, 6, 7, 8)]
    rows = with_features(raw(spark, *days)).collect()
    assert [(row.day_of_week, row.is_weekday) for row in rows] == [
        (6, True),
        (7, False),
        (1, False),
        (2, True),
    ]


def test_time_features_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert with_features(raw(spark, {"event_time": NIGHT})).first().hour_of_day == 23
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    ("change", "residual", "payee"),
    [
        ({"payer_balance_before": 0.0}, 0.0, 0.01),
        ({"payer_balance_before": -0.0}, 0.0, 0.01),
        ({"payer_balance_before": None}, 0.0, 0.01),
        ({"payer_balance_before": None, "payer_balance_after": None}, 0.0, 0.01),
        ({"payee_balance_before": 0.0}, 0.1, 0.0),
        ({"payee_balance_before": None}, 0.1, 0.0),
        ({"payer_balance_before": -10.0}, -0.1, 0.01),
        ({"payer_balance_after": None}, None, 0.01),
        ({"amount": None}, 0.1, None),
    ],
)
def test_ratios_guard_the_prior_balance_only(spark, change, residual, payee):
    row = with_features(raw(spark, change)).first()
    assert (row.residual_balance_ratio, row.payee_amount_ratio) == (residual, payee)


def test_limits_are_strict(spark):
    at_limit = {"amount": 100.0, "payer_balance_after": 9.0, "payee_balance_before": 200.0}
    (row,) = scored(spark, at_limit)
    assert (row.flag_high_amount, row.flag_residual_balance, row.flag_payee_ratio) == (0, 0, 0)
    assert (row.risk_score, row.risk_level) == (0, "NORMAL")


@pytest.mark.parametrize(
    ("change", "score", "level"),
    [
        ({}, 0, "NORMAL"),
        ({"event_time": NIGHT}, 1, "LOW"),
        ({"amount": 101.0}, 1, "LOW"),
        ({"amount": 101.0, "payer_balance_after": 9.9}, 2, "MEDIUM"),
        ({"amount": 101.0, "payer_balance_after": 9.9, "payee_balance_before": 10.0}, 3, "HIGH"),
        ({"event_time": NIGHT, "amount": 101.0}, 3, "HIGH"),
        ({"event_time": NIGHT, "amount": 101.0, "payer_balance_after": 9.9}, 4, "CRITICAL"),
        (
            {
                "event_time": NIGHT,
                "amount": 101.0,
                "payer_balance_after": 9.9,
                "payee_balance_before": 10.0,
            },
            5,
            "CRITICAL",
        ),
        ({"payer_balance_after": None}, None, "NORMAL"),
        ({"amount": None}, None, "NORMAL"),
        ({"amount": float("nan"), "payee_balance_before": 0.0}, 1, "LOW"),
    ],
)
def test_score_and_level(spark, change, score, level):
    (row,) = scored(spark, change)
    assert (row.risk_score, row.risk_level) == (score, level)


def test_null_amount_by_day_and_by_night(spark):
    day, night = scored(spark, {"amount": None}, {"amount": None, "event_time": NIGHT})
    assert (day.flag_night_high_amount, day.flag_high_amount) == (0, None)
    assert (night.flag_night_high_amount, night.flag_high_amount) == (None, None)


def test_derived_columns_follow_the_contract(spark):
    df = to_silver(raw(spark, {}), LIMITS)
    derived = [(f.name, f.dataType) for f in SILVER.fields[14:]]
    assert [(f.name, f.dataType) for f in df.schema.fields[10:]] == derived
    assert df.first().threshold_version == "test"
