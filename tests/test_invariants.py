"""Properties of scored rows and known results, on whole tables."""

import pytest
from pyspark.sql import functions as F

from txrisk.functions.keys import key_day
from txrisk.functions.rules import Thresholds
from txrisk.operators import calibration, gold
from txrisk.operators.bronze import with_transaction_id
from txrisk.operators.silver import to_silver
from txrisk.plans.state import calculate_thresholds
from txrisk.sources.transfers import transfers
from txrisk.schemas import KEY_DAY

THRESHOLDS = {
    "0.001": (143.51, 2.4065469904963037, 0.08811818553938897),
    "0.01": (147.35, 1.0499295727412972, 0.09538160694771956),
    "0.1": (149.18, 1.057645014263698, 0.09428613324209394),
}
# Score -> rows, frauds, rounded amount.
SCORES = {
    "0.001": {
        0: (589, 116, 23916.15),
        1: (359, 78, 19100.79),
        2: (30, 5, 2978.90),
        3: (15, 2, 2674.82),
        4: (7, 0, 1379.53),
    },
    "0.01": {
        0: (5814, 1135, 228313.00),
        1: (3644, 776, 197415.76),
        2: (378, 71, 39083.70),
        3: (126, 22, 23641.53),
        4: (36, 9, 7418.05),
        5: (2, 1, 434.53),
    },
    "0.1": {
        0: (57717, 11286, 2303471.72),
        1: (36753, 7406, 1973743.35),
        2: (3666, 745, 351584.04),
        3: (1431, 280, 268169.63),
        4: (403, 85, 83706.21),
        5: (30, 8, 6155.88),
    },
}


@pytest.fixture(scope="module", params=sorted(THRESHOLDS))
def scored(request, spark):
    rows = transfers(spark, f"/root/testdata/sf{request.param}")
    values = calculate_thresholds(rows, exact=True)
    limits = tuple(values[name] for name in calibration.METRICS)
    frame = to_silver(with_transaction_id(rows), Thresholds(*limits, "v")).cache()
    yield request.param, limits, frame
    frame.unpersist()


def test_known_thresholds_and_scores(scored):
    sf, limits, df = scored
    assert limits == THRESHOLDS[sf]
    totals = df.groupBy("risk_score").agg(
        F.count("*"), F.sum("is_fraud"), F.round(F.sum("amount"), 2)
    )
    assert {row[0]: tuple(row)[1:] for row in totals.collect()} == SCORES[sf]


@pytest.mark.parametrize(
    "broken",
    [
        "flag_night_high_amount <> flag_night * flag_high_amount",
        "(risk_level = 'CRITICAL') <> (flag_night = 1 AND flag_high_amount = 1"
        " AND flag_residual_balance + flag_payee_ratio > 0)",
        "is_night <> (hour_of_day >= 22 OR hour_of_day < 6)",
        "risk_score > 3 AND NOT (is_night AND flag_high_amount = 1)",
        "(risk_score >= 3) <> (risk_level IN ('HIGH', 'CRITICAL'))",
    ],
)
def test_no_row_breaks(scored, broken):
    assert scored[2].where(broken).isEmpty()


def test_snapshots_cover_all_rows_and_agree_with_their_base(scored):
    df = scored[2]
    rows = df.count()
    base = gold.daily_totals(df.withColumn(KEY_DAY, key_day()))
    for direct, rolled, keys in (
        (gold.risk_effectiveness(df), gold.risk_effectiveness_from(base), 1),
        (gold.operational(df), gold.operational_from(base), 2),
    ):
        expected = {tuple(row)[:keys]: tuple(row)[keys:] for row in direct.collect()}
        found = {tuple(row)[:keys]: tuple(row)[keys:] for row in rolled.collect()}
        assert sum(value[0] for value in found.values()) == rows
        assert found.keys() == expected.keys()
        for key, (count, frauds, amount) in expected.items():
            assert found[key] == (count, frauds, pytest.approx(amount))


def test_alerts_are_the_high_and_critical_rows(scored):
    df = scored[2]
    expected = df.where("risk_level IN ('HIGH', 'CRITICAL')").select("transaction_id")
    assert sorted(gold.alerts(df).select("transaction_id").collect()) == sorted(expected.collect())
    assert df.select("transaction_id").distinct().count() == df.count()


def test_daily_totals_are_small_and_keep_null_groups(spark, scored):
    df = scored[2].withColumn("is_night", F.when(F.col("hour_of_day") > 0, F.col("is_night")))
    df = df.withColumn(KEY_DAY, key_day())
    base = gold.daily_totals(df)
    assert base.count() <= 54 * df.select(KEY_DAY).distinct().count()
    found = {row.is_night for row in gold.operational_from(base).collect()}
    assert found == {True, False, None}
