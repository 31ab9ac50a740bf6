import os
import time
import uuid
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import raw

from txrisk.errors import (
    CalibrationError,
    DuplicateKeyError,
    MissingColumnsError,
    MissingTableError,
    NoActiveThresholdsError,
    QualityGateError,
)
from txrisk.functions.instants import to_micros
from txrisk.plans import jobs, state
from txrisk.plans.settings import Settings
from txrisk.schemas import ALERTS, BRONZE, OPERATIONAL, RISK_EFFECTIVENESS, SILVER
from txrisk.sources import tables
from txrisk.sources.tables import read_table, table_exists

TABLES = (
    "bronze silver control ingest_day watermark threshold gate_result gold_total gold_risk gold_operational gold_alerts"
).split()


@pytest.fixture
def deployed(tmp_path):
    names = {f"{table}_table": f"{table}_{uuid.uuid4().hex}" for table in TABLES}
    return Settings(str(tmp_path / "raw"), str(tmp_path / "tables"), **names)


def transfers(spark, ids, **changes):
    """Transfers on alternating days and hours; every fifth one is large."""
    rows = [
        {
            "payer_id": f"p{i}",
            "amount": 500.0 + i if i % 5 == 0 else 10.0 + i,
            "event_time": datetime(2024, 1, 1 + i % 4, (i * 5 + 17) % 24),
            **changes,
        }
        for i in ids
    ]
    return raw(spark, *rows)


def deliver(df, deployed):
    df.coalesce(1).write.mode("append").parquet(deployed.source_path)


def marks(spark, deployed):
    return {layer: state.get_watermark(spark, deployed.watermarks, layer) for layer in ("silver", "gold")}


def rows(spark, table):
    return sorted(tuple(row) for row in read_table(spark, table).collect())


def snapshot(spark, deployed):
    tables = (
        deployed.bronze,
        deployed.silver,
        deployed.control,
        deployed.watermarks,
        deployed.thresholds,
        deployed.gold_risk,
        deployed.gold_operational,
        deployed.gold_alerts,
    )
    return [sorted(map(repr, rows(spark, table))) for table in tables]


def test_daily_run_from_nothing(spark, deployed):
    deliver(transfers(spark, range(40)), deployed)
    jobs.run_daily(spark, deployed)

    for table, schema, count in (
        (deployed.bronze, BRONZE, 40),
        (deployed.silver, SILVER, 40),
        (deployed.control, None, 1),
        (deployed.thresholds, None, 1),
        (deployed.watermarks, None, 2),
    ):
        df = read_table(spark, table)
        assert df.count() == count
        if schema is not None:
            assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]

    silver = read_table(spark, deployed.silver)
    for table, schema in ((deployed.gold_risk, RISK_EFFECTIVENESS), (deployed.gold_operational, OPERATIONAL)):
        df = read_table(spark, table)
        assert df.columns == schema.names
        assert df.agg(F.sum("tx_count")).first()[0] == 40
    alerts = read_table(spark, deployed.gold_alerts)
    assert alerts.columns == ALERTS.names
    assert alerts.count() == silver.where("risk_score >= 3").count() > 0
    highest = silver.select(F.max(F.unix_micros("ingested_at"))).first()[0]
    assert marks(spark, deployed) == {"silver": highest, "gold": highest}


def test_replay_changes_nothing(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    before = snapshot(spark, deployed)
    assert jobs.ingest(spark, deployed) == 0
    assert jobs.bootstrap_thresholds(spark, deployed) is None
    assert jobs.score(spark, deployed) == 0
    assert jobs.publish_gold(spark, deployed) == 0
    assert snapshot(spark, deployed) == before


def test_resent_rows_replace_and_pass_all_layers_again(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    first = marks(spark, deployed)
    deliver(transfers(spark, range(15, 25), is_fraud=1), deployed)
    jobs.run_daily(spark, deployed)

    for table in (deployed.bronze, deployed.silver):
        df = read_table(spark, table)
        assert df.count() == 25
        assert df.where("is_fraud = 1").count() == 10
        assert df.select("ingested_at").distinct().count() == 2
    assert read_table(spark, deployed.gold_risk).agg(F.sum("fraud_count")).first()[0] == 10
    second = marks(spark, deployed)
    assert second["silver"] == second["gold"] > first["gold"]
    assert read_table(spark, deployed.silver).select("threshold_version").distinct().count() == 1


def test_failing_gate_writes_nothing(spark, deployed):
    deliver(transfers(spark, range(10)), deployed)
    jobs.run_daily(spark, deployed)
    silver, before = rows(spark, deployed.silver), marks(spark, deployed)
    bad = transfers(spark, [30], amount=0.0).unionByName(transfers(spark, [31], is_fraud=None))
    bad = bad.unionByName(transfers(spark, [32], is_fraud=2))
    deliver(bad.unionByName(transfers(spark, [33], payer_balance_after=None)), deployed)
    jobs.ingest(spark, deployed)
    with pytest.raises(QualityGateError) as failed:
        jobs.score(spark, deployed)
    assert failed.value.failures == [
        "null_fraud = 1",
        "nonpositive_amount = 1",
        "fraud_out_of_domain = 1",
        "missing_score = 1",
    ]
    assert rows(spark, deployed.silver) == silver
    assert marks(spark, deployed) == before


def test_gate_compares_counts(spark):
    from rows import LIMITS

    from txrisk.operators.silver import to_silver

    scored = to_silver(raw(spark, {}, {}), LIMITS)
    unknown = to_silver(raw(spark, {"amount": None}), LIMITS)
    with pytest.raises(QualityGateError) as failed:
        jobs.check_quality(unknown, 1)
    assert failed.value.failures == ["missing_score = 1"]
    with pytest.raises(QualityGateError, match="count_mismatch = 1"):
        jobs.check_quality(scored, 3)
    assert jobs.check_quality(scored, 2)["fraud_rate"] == 0.0
    assert jobs.check_quality(scored.limit(0), 0)["critical_rate"] == 0.0


def test_recalibration_closes_one_row_and_keeps_old_scores(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    first = state.get_active_threshold(spark, deployed.thresholds)
    deliver(transfers(spark, range(20, 40), payee_balance_before=5.0), deployed)
    jobs.ingest(spark, deployed)
    second = jobs.recalibrate(spark, deployed)
    third = jobs.recalibrate(spark, deployed)

    history = read_table(spark, deployed.thresholds)
    assert history.where("valid_to IS NULL").count() == 1
    assert history.where(
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))
    ).count() == 3
    closed = {row.threshold_version: row.valid_to for row in history.collect()}
    starts = {row.threshold_version: row.valid_from for row in history.collect()}
    assert closed[first.version] == starts[second] and closed[second] == starts[third]
    active = state.get_active_threshold(spark, deployed.thresholds)
    assert active.version == third
    assert active.payee_amount_ratio > first.payee_amount_ratio

    jobs.score(spark, deployed)
    versions = read_table(spark, deployed.silver).groupBy("threshold_version").count().collect()
    assert {tuple(row) for row in versions} == {(first.version, 20), (third, 20)}


def test_publication_lost_halfway_leaves_an_active_version(spark, deployed, monkeypatch):
    values = {"p95_amount": 1.0, "p95_residual_balance_ratio": 2.0, "p95_payee_amount_ratio": 3.0}
    first = state.publish_thresholds(spark, deployed.thresholds, values, 1_000_000)
    with monkeypatch.context() as patched:
        patched.setattr(state, "replace_parts", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.publish_thresholds(spark, deployed.thresholds, values | {"p95_amount": 5.0}, 2_000_000)
    active = state.get_active_threshold(spark, deployed.thresholds)
    assert (active.amount, active.version > first) == (5.0, True)
    last = state.publish_thresholds(spark, deployed.thresholds, values, 3_000_000)
    history = read_table(spark, deployed.thresholds)
    assert [row[0] for row in history.where("valid_to IS NULL").collect()] == [last]
    assert history.count() == 3


def test_gold_watermark_moves_last(spark, deployed, monkeypatch):
    deliver(transfers(spark, range(20)), deployed)
    jobs.ingest(spark, deployed)
    jobs.bootstrap_thresholds(spark, deployed)
    jobs.score(spark, deployed)
    with monkeypatch.context() as patched:
        patched.setattr(jobs, "upsert", lambda *args, **kwargs: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.publish_gold(spark, deployed)
    assert marks(spark, deployed)["gold"] is None
    assert jobs.publish_gold(spark, deployed) == 20
    assert marks(spark, deployed)["gold"] == marks(spark, deployed)["silver"]


def test_ingest_heals_a_failure_before_the_log(spark, deployed, monkeypatch):
    deliver(transfers(spark, range(10)), deployed)
    with monkeypatch.context() as patched:
        whole = jobs.append

        def lost(spark, table, *args):
            if table == deployed.control:
                raise OSError("lost")
            whole(spark, table, *args)

        patched.setattr(jobs, "append", lost)
        with pytest.raises(OSError):
            jobs.ingest(spark, deployed)
    assert not table_exists(spark, deployed.control)
    assert jobs.ingest(spark, deployed) == 1
    assert read_table(spark, deployed.bronze).count() == 10
    logged = read_table(spark, deployed.control).select("source_file").first()[0]
    stored = read_table(spark, deployed.bronze).select("source_file").distinct().collect()
    assert [row[0] for row in stored] == [logged]


def test_alert_stays_when_its_row_drops_below_the_cut(spark, deployed):
    night = datetime(2024, 1, 2, 23, 0)
    deliver(transfers(spark, range(20)), deployed)
    deliver(transfers(spark, [99], event_time=night, amount=9000.0, payee_balance_before=1.0), deployed)
    jobs.run_daily(spark, deployed)
    alerts = rows(spark, deployed.gold_alerts)
    assert any(row[2] == "p99" for row in alerts)
    deliver(transfers(spark, range(200, 400), event_time=datetime(2024, 1, 5, 12), amount=9e6), deployed)
    jobs.ingest(spark, deployed)
    jobs.recalibrate(spark, deployed)
    deliver(
        transfers(spark, [99], event_time=night, amount=9000.0, payee_balance_before=1e9), deployed
    )
    jobs.run_daily(spark, deployed)
    row = read_table(spark, deployed.silver).where("payer_id = 'p99'").first()
    assert row.risk_score < 3
    assert any(row[2] == "p99" for row in rows(spark, deployed.gold_alerts))


def test_repeated_keys_are_stored_first_and_refused_when_they_match(spark, deployed):
    twice = transfers(spark, [1]).unionByName(transfers(spark, [1], is_fraud=1))
    deliver(twice.unionByName(transfers(spark, [2])), deployed)
    jobs.ingest(spark, deployed)
    assert read_table(spark, deployed.bronze).count() == 3
    deliver(twice, deployed)
    with pytest.raises(DuplicateKeyError):
        jobs.ingest(spark, deployed)
    assert read_table(spark, deployed.bronze).count() == 3


def test_missing_inputs_are_named(spark, deployed):
    with pytest.raises(MissingTableError, match=deployed.bronze_table):
        jobs.bootstrap_thresholds(spark, deployed)
    with pytest.raises(NoActiveThresholdsError):
        jobs.score(spark, deployed)
    deliver(transfers(spark, [1]).drop("amount"), deployed)
    with pytest.raises(MissingColumnsError, match="amount"):
        jobs.ingest(spark, deployed)
    assert not table_exists(spark, deployed.control)


def test_calibration_of_no_rows(spark, deployed):
    deliver(transfers(spark, [1]).limit(0), deployed)
    jobs.ingest(spark, deployed)
    with pytest.raises(CalibrationError):
        jobs.bootstrap_thresholds(spark, deployed)


def test_source_columns_may_have_other_names(spark, deployed):
    renamed = transfers(spark, range(5)).withColumnRenamed("amount", "value").withColumn("extra", F.lit(1))
    deliver(renamed, deployed)
    other = Settings(**{**vars(deployed), "source_columns": {"amount": "value"}})
    assert jobs.ingest(spark, other) == 1
    assert read_table(spark, other.bronze).columns == BRONZE.names


def test_alert_score_is_a_setting(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, Settings(**{**vars(deployed), "alert_score": 1}))
    expected = read_table(spark, deployed.silver).where("risk_score >= 1").count()
    assert read_table(spark, deployed.gold_alerts).count() == expected


def test_new_session_state_is_found_by_directory(spark, deployed):
    deliver(transfers(spark, range(10)), deployed)
    jobs.run_daily(spark, deployed)
    before = snapshot(spark, deployed)
    for table in TABLES:
        spark.sql(f"DROP TABLE {getattr(deployed, f'{table}_table')}")
    jobs.run_daily(spark, deployed)
    assert snapshot(spark, deployed) == before


def test_watermark_survives_a_repeated_local_hour(spark, deployed):
    zone = spark.conf.get("spark.sql.session.timeZone")
    instants = [to_micros(datetime(2024, 10, 27, hour, 30, tzinfo=timezone.utc)) for hour in (0, 1)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        for micros in instants:
            state.set_watermark(spark, deployed.watermarks, "silver", micros)
            assert state.get_watermark(spark, deployed.watermarks, "silver") == micros
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert state.get_watermark(spark, deployed.watermarks, "gold") is None
    assert read_table(spark, deployed.watermarks).count() == 1


def test_old_file_times_lose_no_rows(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    deliver(transfers(spark, range(20, 40)), deployed)
    jobs.ingest(spark, deployed)
    long_ago = time.time() - 10 * 24 * 3600
    for file in Path(deployed.bronze.location).rglob("*.parquet"):
        os.utime(file, (long_ago, long_ago))
    spark.catalog.refreshTable(deployed.bronze.name)
    assert jobs.score(spark, deployed) == 20
    assert read_table(spark, deployed.silver).count() == 40


def test_a_clock_set_back_loses_no_rows(spark, deployed, monkeypatch):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    now = jobs.now_micros()
    monkeypatch.setattr(jobs, "now_micros", lambda: now - 3_600_000_000)
    deliver(transfers(spark, range(20, 40)), deployed)
    jobs.run_daily(spark, deployed)
    assert read_table(spark, deployed.silver).count() == 40
    assert read_table(spark, deployed.gold_risk).agg(F.sum("tx_count")).first()[0] == 40


def test_files_come_in_slices(spark, deployed):
    for i in range(5):
        deliver(transfers(spark, range(i * 4, i * 4 + 4)), deployed)
    sliced = Settings(**{**vars(deployed), "files_per_batch": 2})
    assert jobs.ingest(spark, sliced) == 5
    assert read_table(spark, deployed.bronze).select("ingested_at").distinct().count() == 3
    assert read_table(spark, deployed.bronze).count() == 20
    assert jobs.ingest(spark, sliced) == 0


def test_a_file_that_lacks_a_column_is_named_and_nothing_is_logged(spark, deployed):
    deliver(transfers(spark, range(5)), deployed)
    deliver(transfers(spark, range(5, 9)).drop("is_fraud"), deployed)
    with pytest.raises(MissingColumnsError, match=r"is_fraud \(in .*parquet"):
        jobs.ingest(spark, deployed)
    assert not table_exists(spark, deployed.control) and not table_exists(spark, deployed.bronze)


def test_files_of_other_number_types_are_read_together(spark, deployed):
    deliver(transfers(spark, range(5)), deployed)
    decimal = F.col("amount").cast("decimal(18,2)")
    deliver(transfers(spark, range(5, 9)).withColumn("amount", decimal), deployed)
    assert jobs.ingest(spark, deployed) == 2
    amounts = read_table(spark, deployed.bronze).agg(F.sum("amount")).first()[0]
    assert amounts == pytest.approx(transfers(spark, range(9)).agg(F.sum("amount")).first()[0])


@pytest.mark.parametrize("step", ["ingest", "score", "publish_gold"])
def test_repeated_keys_survive_a_loss_at_every_step(spark, deployed, monkeypatch, step):
    twice = transfers(spark, range(10)).unionByName(transfers(spark, [3, 5], is_fraud=1))
    deliver(twice, deployed)
    marks_table = {"ingest": deployed.control}.get(step, deployed.watermarks)

    def lost(original):
        def write(spark, table, *args, **kwargs):
            if table == marks_table:
                raise OSError("lost")
            return original(spark, table, *args, **kwargs)

        return write

    jobs_before = ["ingest", "bootstrap_thresholds", "score", "publish_gold"]
    for name in jobs_before[: jobs_before.index(step)]:
        getattr(jobs, name)(spark, deployed)
    with monkeypatch.context() as patched:
        patched.setattr(jobs, "append", lost(jobs.append))
        patched.setattr(jobs, "set_watermark", lost(jobs.set_watermark))
        with pytest.raises(OSError):
            getattr(jobs, step)(spark, deployed)
    jobs.run_daily(spark, deployed)
    for table in (deployed.bronze, deployed.silver):
        assert read_table(spark, table).count() == 12
    assert read_table(spark, deployed.gold_risk).agg(F.sum("tx_count")).first()[0] == 12


def test_gold_counts_only_the_days_of_its_batch(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    other = Path(deployed.silver.location) / "key_day=2024-01-03"
    for file in other.rglob("*.parquet"):
        file.write_text("cannot be read")
    for checksum in other.rglob(".*.crc"):
        checksum.unlink()
    resent = transfers(spark, [i for i in range(20) if i % 4 == 0], is_fraud=1)
    deliver(resent, deployed)
    jobs.run_daily(spark, deployed)
    totals = read_table(spark, deployed.gold_risk).agg(F.sum("tx_count"), F.sum("fraud_count")).first()
    assert tuple(totals) == (20, 5)


def test_new_days_are_appended_without_a_probe(spark, deployed):
    deliver(transfers(spark, range(8)), deployed)
    jobs.run_daily(spark, deployed)
    probes = []
    later = [datetime(2024, 3, 1 + i, 12) for i in range(3)]
    for i, at in enumerate(later):
        deliver(transfers(spark, [100 + i], event_time=at), deployed)
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(tables, "matched_parts", lambda *args: probes.append(args))
        jobs.run_daily(spark, deployed)
    assert probes == [] and read_table(spark, deployed.silver).count() == 11


def test_days_not_in_the_batch_are_not_opened(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.run_daily(spark, deployed)
    long_ago = time.time() - 10 * 24 * 3600
    for table in (deployed.bronze, deployed.silver):
        for file in Path(table.location).rglob("*.parquet"):
            file.write_text("cannot be read")
            os.utime(file, (long_ago, long_ago))
        for checksum in Path(table.location).rglob(".*.crc"):
            checksum.unlink()
        spark.catalog.refreshTable(table.name)
    deliver(transfers(spark, range(20, 30), event_time=datetime(2024, 2, 1, 12)), deployed)
    jobs.ingest(spark, deployed)
    assert jobs.score(spark, deployed) == 10
    batch = jobs.next_batch(spark, deployed, deployed.silver, "gold")
    assert (batch.count, batch.days) == (10, ["2024-02-01"])


def test_incremental_scan_is_pruned(spark, deployed):
    deliver(transfers(spark, range(20)), deployed)
    jobs.ingest(spark, deployed)
    batch = jobs.next_batch(spark, deployed, deployed.bronze, "silver")
    plan = batch.rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at), LessThanOrEqual(ingested_at" in plan
    assert "PartitionFilters: [key_day" in plan
    assert (batch.count, len(batch.days)) == (20, 4)


class _Session:
    """Just what use_checkpoint_dir asks a session for."""

    def __init__(self, current=None, **conf):
        self.folder, self.sparkContext, self.conf = current, self, self
        self.values = {name.replace("_", "."): value for name, value in conf.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize(
    ("session", "tables", "expected"),
    [
        (_Session("hdfs://c/given"), "/tables", "hdfs://c/given"),
        (_Session(spark_checkpoint_dir="hdfs://c/conf"), "/tables", "hdfs://c/conf"),
        (_Session(spark_sql_warehouse_dir="/wh"), "/given", "/given"),
    ],
)
def test_checkpoints_go_where_the_session_says(session, tables, expected):
    jobs.use_checkpoint_dir(session, tables)
    assert session.folder == expected


def test_without_a_shared_folder_there_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        jobs.use_checkpoint_dir(_Session(spark_sql_warehouse_dir="/wh"))


def test_a_refused_batch_that_runs_again_is_kept_once(spark, deployed):
    deliver(transfers(spark, range(8)), deployed)
    jobs.run_daily(spark, deployed)
    deliver(transfers(spark, range(8, 12), amount=0.0), deployed)
    for _ in range(3):
        with pytest.raises(QualityGateError):
            jobs.run_daily(spark, deployed)
    kept = read_table(spark, deployed.gate_results).groupBy("checked_to", "check_name").count().collect()
    assert len(kept) == 14 and {row["count"] for row in kept} == {1}


def test_stream_and_listing_take_turns(spark, deployed, tmp_path, monkeypatch):
    checkpoint = str(tmp_path / "stream")
    deliver(transfers(spark, range(4)), deployed)
    jobs.ingest(spark, deployed)
    deliver(transfers(spark, range(4, 9)), deployed)
    # the slice is lost after its rows are stored and before the log: the stream gives it again
    with monkeypatch.context() as patched:
        patched.setattr(jobs, "log_rows", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            jobs.ingest_stream(spark, deployed, checkpoint)
    assert jobs.ingest_stream(spark, deployed, checkpoint) > 0
    assert jobs.ingest_stream(spark, deployed, checkpoint) == 0 == jobs.ingest(spark, deployed)
    assert read_table(spark, deployed.bronze).count() == 9


def test_window_leaves_out_old_days_and_follows_replaced_rows(spark, deployed):
    for day, amount in ((1, 900.0), (8, 10.0), (9, 20.0)):
        deliver(transfers(spark, range(day * 10, day * 10 + 4), event_time=datetime(2024, 1, day, 12), amount=amount), deployed)
    jobs.ingest(spark, deployed)

    def amount_of(days):
        jobs.recalibrate_window(spark, deployed, days)
        return state.get_active_threshold(spark, deployed.thresholds).amount

    assert [amount_of(days) for days in (1, 2, 9)] == [20.0, 20.0, 900.0]
    assert jobs.refresh_sketches(spark, deployed) == []
    deliver(transfers(spark, range(100, 101), event_time=datetime(2024, 1, 8, 13), amount=500.0), deployed)
    jobs.ingest(spark, deployed)
    assert jobs.refresh_sketches(spark, deployed) == ["2024-01-08"]
    assert [amount_of(days) for days in (1, 2)] == [20.0, 500.0]


def test_a_changed_file_takes_its_old_rows_back(spark, deployed, tmp_path):
    again = replace(deployed, reread_changed=True)
    days = [datetime(2024, 1, day, 12) for day in (1, 2)]
    rows = transfers(spark, range(3), event_time=days[0]).unionByName(transfers(spark, range(10, 14), event_time=days[1]))
    deliver(rows, again)
    (path,) = Path(again.source_path).glob("*.parquet")
    deliver(transfers(spark, range(20, 25), event_time=days[0]), again)
    jobs.run_daily(spark, again)

    def rewrite(rows):
        rows.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "new"))
        (new,) = (tmp_path / "new").glob("*.parquet")
        path.write_bytes(new.read_bytes())
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)

    def held():
        silver = read_table(spark, again.silver)
        totals = read_table(spark, again.gold_risk).agg(F.sum("tx_count")).first()[0]
        assert read_table(spark, again.bronze).count() == silver.count() == totals
        return {row[0] for row in silver.select("payer_id").collect()}

    others = {f"p{i}" for i in range(20, 25)}
    assert held() == {f"p{i}" for i in (0, 1, 2, 10, 11, 12, 13)} | others
    # a row fewer on one day, and none of the other day
    rewrite(transfers(spark, [0, 2], event_time=days[0]))
    jobs.run_daily(spark, again)
    assert held() == {"p0", "p2"} | others
    assert {row[0] for row in read_table(spark, again.gold_totals).select("key_day").distinct().collect()} == {"2024-01-01"}
    # the day comes back, and a run without a change takes nothing
    rewrite(rows)
    jobs.run_daily(spark, again)
    jobs.run_daily(spark, again)
    assert held() == {f"p{i}" for i in (0, 1, 2, 10, 11, 12, 13)} | others
