"""Transfers derived from the sample tables: rows, and how often and by what joins they are derived."""

from datetime import datetime

import pytest

from txrisk.plans import catalogue
from txrisk.sources.transfers import transfers

BALANCE = {1: 100.0, 2: 0.0, 3: None}


@pytest.fixture
def tables(spark, tmp_path):
    """Four events of three payers, one of them without a payer."""
    events = [(i, datetime(2024, 1, 14 + i, 4), user, "view", 10.0 * i) for i, user in enumerate([1, 2, 3, 9])]
    for name, rows, schema in (
        ("events", events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"),
        ("customer", list(BALANCE.items()), "c_custkey bigint, c_acctbal double"),
        ("supplier", [(0, 5.0), (1, 7.0)], "s_suppkey bigint, s_acctbal double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def counted(monkeypatch):
    calls = []
    monkeypatch.setattr(catalogue, "transfers", lambda *args: calls.append(args) or transfers(*args))
    return calls


def test_payers_are_not_sent_to_the_driver(spark, tables):
    rows = transfers(spark, tables)
    joins = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in joins
    found = {(row["payer_id"], row["payee_id"], row["payer_balance_before"]) for row in rows.collect()}
    assert found == {("1", "0", 100.0), ("2", "1", 0.0), ("3", "0", None)}


def test_calibration_guard_derives_transfers_once(spark, tables, monkeypatch):
    calls = counted(monkeypatch)
    found = catalogue.calibration_guard(spark, tables)
    counts = {(row["history"], row["metric"]): (row["value_count"], row["refused"]) for row in found.collect()}
    assert counts["whole", "p95_amount"] == (3, False)
    assert counts["no payer balances", "p95_residual_balance_ratio"] == (2, False)
    assert counts["before the first event", "p95_amount"] == (0, True)
    assert len(calls) == 1
