import math
import random

import pytest
from pyspark.sql import functions as F
from rows import raw

from txrisk.errors import CalibrationError
from txrisk.operators import calibration
from txrisk.plans.state import calculate_thresholds


def frame(spark, amounts):
    """Amounts as given; the residual ratio equals the amount and the payee ratio twice that."""
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    return df.repartition(7).select(
        "amount",
        F.lit(1.0).alias("payer_balance_before"),
        F.col("amount").alias("payer_balance_after"),
        F.lit(0.5).alias("payee_balance_before"),
    )


def by_rank(amounts, fraction):
    values = sorted((a for a in amounts if a is not None), key=lambda a: (math.isnan(a), a))
    return values[max(math.ceil(round(fraction * len(values), 9)), 1) - 1]


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


RANDOM = random.Random(7)
SAMPLES = {
    "spread": [RANDOM.uniform(-1e6, 1e6) for _ in range(30_000)],
    "heavy tail": [RANDOM.paretovariate(0.3) for _ in range(30_000)],
    "third is one value": [5.0] * 10_000 + [RANDOM.uniform(0, 10) for _ in range(20_000)],
    "hot value at the rank": [RANDOM.random() for _ in range(18_000)] + [2.0] * 10_000 + [3.0] * 500,
    "few values": [float(RANDOM.randrange(5)) for _ in range(20_000)],
    "all equal": [1.5] * 5_000,
    "nulls": [None] * 3_000 + [RANDOM.gauss(0, 1) for _ in range(20_000)],
    "nan": [math.nan] * 3_000 + [RANDOM.gauss(0, 1) for _ in range(20_000)],
    "some nan": [math.nan] * 100 + [RANDOM.gauss(0, 1) for _ in range(20_000)],
    "single": [4.0],
    "twenty": [float(i) for i in range(20)],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("max_rows", [1, 1_000_000])
def test_exact_percentile_equals_sorting(spark, name, max_rows):
    row = calibration.exact_thresholds(frame(spark, SAMPLES[name]), max_rows=max_rows).first()
    expected = by_rank(SAMPLES[name], 0.95)
    assert same(row.p95_amount, expected)
    assert same(row.p95_residual_balance_ratio, expected)
    assert same(row.p95_payee_amount_ratio, 2 * expected)


@pytest.mark.parametrize("fraction", ["0.01", "0.5", "1"])
def test_exact_percentile_at_other_fractions(spark, fraction):
    amounts = SAMPLES["third is one value"]
    row = calibration.exact_thresholds(frame(spark, amounts), fraction, max_rows=10).first()
    assert row.p95_amount == by_rank(amounts, float(fraction))


@pytest.mark.parametrize("name", ["spread", "heavy tail", "third is one value", "nulls"])
def test_approximate_percentile_is_within_its_rank_error(spark, name):
    values = sorted(a for a in SAMPLES[name] if a is not None)
    found = calibration.approximate_thresholds(frame(spark, SAMPLES[name])).first().p95_amount
    slack = len(values) / 10_000 + 1
    assert sum(v < found for v in values) + 1 - slack <= 0.95 * len(values)
    assert sum(v <= found for v in values) + slack >= 0.95 * len(values)


def test_guarded_ratios_count_as_zero(spark):
    df = raw(spark, *[{"payer_balance_before": 0.0}] * 99, {})
    assert calculate_thresholds(df)["p95_residual_balance_ratio"] == 0.0
    assert calculate_thresholds(df, exact=True)["p95_residual_balance_ratio"] == 0.0


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("amounts", [[], [None, None]])
def test_no_amounts_is_an_error(spark, exact, amounts):
    df = frame(spark, [1.0]).where("false") if not amounts else frame(spark, amounts)
    with pytest.raises(CalibrationError):
        calculate_thresholds(df, exact)


def test_scan_reads_four_columns(spark, tmp_path):
    raw(spark, {}).write.parquet(str(tmp_path / "t"))
    df = calibration.approximate_thresholds(spark.read.parquet(str(tmp_path / "t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    unread = ("payer_id", "payee_id", "tx_type", "event_time", "payee_balance_after", "is_fraud")
    assert "payee_balance_before" in plan and not any(name in plan for name in unread)
