"""The jobs. Each is safe to run again: it does nothing without new input, and a rerun after a
failure repeats the same upserts. Instants are literals, so all reads of a batch see one batch."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.errors import NoActiveThresholdsError, QualityGateError, WatermarkError
from txrisk.functions.instants import instant, now_micros
from txrisk.operators import gold
from txrisk.operators.bronze import to_bronze
from txrisk.operators.calibration import day_sketches
from txrisk.operators.quality import quality_checks, quality_metrics
from txrisk.operators.silver import to_silver
from txrisk.plans.settings import Settings
from txrisk.plans.state import (
    calculate_thresholds,
    get_active_threshold,
    get_watermark,
    publish_thresholds,
    set_watermark,
    window_thresholds,
)
from txrisk.schemas import ALERTS, FILE_VERSIONS, INGESTED_FILES, KEY_DAY
from txrisk.sources.files import (
    list_files,
    log_rows,
    new_files,
    new_versions,
    processed_files,
    scan_files,
    stream_files,
)
from txrisk.sources.tables import (
    append,
    compact,
    kept_once,
    overwrite,
    part_sizes,
    read_or_empty,
    read_table,
    remove_rows,
    replace_parts,
    stored_rows,
    table_exists,
    upsert,
)
from txrisk.streaming.progress import batch_bounds, days_after, rows_after

log = logging.getLogger(__name__)


def ingest(spark: SparkSession, settings: Settings) -> int:
    """Store the rows of files not yet logged as done; returns the number of files.

    Only file names pass through the driver, as every Spark file scan needs them there, a slice at a
    time. The log is written last: after a failure in between, the files are read again and their
    rows match.
    """
    listed = list_files(spark, settings.source_path)
    if settings.reread_changed:
        listed = new_versions(listed, read_or_empty(spark, settings.file_versions))
    else:
        listed = new_files(listed, processed_files(read_or_empty(spark, settings.control)))
    listed = kept_once(listed)
    count, last = 0, None
    while True:
        rest = listed if last is None else listed.where(F.col("source_file") > last)
        files = rest.orderBy("source_file").limit(settings.files_per_batch).collect()
        if not files:
            break
        _ingest_files(spark, settings, files)
        count, last = count + len(files), files[-1]["source_file"]
    log.info("ingested %d files", count)
    return count


def _ingest_files(spark: SparkSession, settings: Settings, files: list) -> None:
    """One slice of files, under an ingest instant of its own that is above all earlier ones."""
    newest = newest_ingest(spark, settings)
    at = instant(max(now_micros(), 0 if newest is None else newest + 1))
    rows = scan_files(
        spark,
        [file["path"] for file in files],
        lambda raw: to_bronze(raw, at, settings.source_columns, with_key_day=True),
    )
    days = part_sizes(rows, KEY_DAY)
    # before the rows: a day that turns out to have no new row costs a look, a missing one costs rows
    written = spark.createDataFrame([(day,) for day in days], f"{KEY_DAY} string")
    append(spark, settings.ingest_days, written.select(at.alias("ingested_at"), KEY_DAY).coalesce(1))
    upsert(
        spark,
        settings.bronze,
        rows,
        "transaction_id",
        days,
        on_duplicate=settings.on_duplicate,
        gather=settings.gather_source,
        replayed=["source_file"],
    )
    names = spark.createDataFrame([(f["source_file"],) for f in files], INGESTED_FILES.names[:1])
    if settings.reread_changed:
        _retract_earlier(spark, settings, names, at)
        seen = spark.createDataFrame(files).select(*FILE_VERSIONS.names[:3], at.alias("ingested_at"))
        append(spark, settings.file_versions, seen.coalesce(1))
    append(spark, settings.control, log_rows(names, F.current_timestamp()).coalesce(1))


def _retract_earlier(spark: SparkSession, settings: Settings, names: DataFrame, at: Column) -> None:
    """Rows that only an earlier version of these files had leave Bronze. The log of ingests says in which
    days they can be. What is taken out is noted first, for the layers above."""
    earlier = read_or_empty(spark, settings.file_versions).join(names, "source_file", "left_semi")
    days = earlier.join(read_table(spark, settings.ingest_days), "ingested_at").select("source_file", KEY_DAY)
    noted = kept_once(days.distinct().select(at.alias("ingested_at"), "source_file", KEY_DAY))
    if noted.isEmpty():
        return
    append(spark, settings.retractions, noted.coalesce(1))
    gone = noted.select("source_file", F.col("ingested_at").alias("before")).distinct()
    parts = [row[0] for row in noted.select(KEY_DAY).distinct().collect()]
    log.info("retracted %d rows", remove_rows(spark, settings.bronze, gone, parts))


def _retracted(spark: SparkSession, settings: Settings, layer: str) -> tuple[DataFrame, list[str]]:
    """What a layer still has to take out: (source_file, before), and the days it can be in. Nothing is
    ever retracted, and nothing looked up, where changed files are not read again."""
    if not settings.reread_changed:
        return spark.createDataFrame([], "source_file string, before timestamp"), []
    mark = get_watermark(spark, settings.watermarks, layer)
    open_ = rows_after(read_or_empty(spark, settings.retractions), None if mark is None else instant(mark))
    days = [row[0] for row in open_.select(KEY_DAY).distinct().collect()]
    return open_.groupBy("source_file").agg(F.max("ingested_at").alias("before")), days


def ingest_stream(spark: SparkSession, settings: Settings, checkpoint: str) -> int:
    """The same ingest from a file stream: everything that is there now, ``files_per_batch`` files at a
    time, then it ends; returns the number of files.

    The stream's checkpoint says which files it has seen, so a run that follows lists and takes only
    later ones. Names are all that streams; a slice is stored as in ``ingest`` and logged. A slice
    that was lost before its checkpoint is given again, and files that the log has as done are left
    out, so stream and plain ingest may also take turns.
    """
    taken = []

    def store(names: DataFrame, _: int) -> None:
        done = processed_files(read_or_empty(spark, settings.control))
        files = new_files(names, done).orderBy("source_file").collect()
        if files:
            _ingest_files(spark, settings, files)
        taken.append(len(files))

    names = stream_files(spark, settings.source_path, settings.files_per_batch)
    query = names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    log.info("ingested %d files of the stream", sum(taken))
    return sum(taken)


def newest_ingest(spark: SparkSession, settings: Settings) -> int | None:
    """The highest ingest instant given out so far, in microseconds."""
    ingests = read_or_empty(spark, settings.ingest_days)
    return ingests.agg(F.unix_micros(F.max("ingested_at"))).first()[0]


def recalibrate(spark: SparkSession, settings: Settings) -> str:
    """Calibrate on the history as it is now and publish a new version; returns it.

    All scans are bounded by the newest ingest instant, so an ingest meanwhile is left out of all."""
    newest = newest_ingest(spark, settings)
    history = read_table(spark, settings.bronze)
    if newest is not None:
        history = rows_after(history, None, instant(newest))
    values = calculate_thresholds(history, settings.exact_thresholds)
    version = publish_thresholds(spark, settings.thresholds, values, now_micros())
    log.info("published thresholds %s: %s", version, values)
    return version


def refresh_sketches(spark: SparkSession, settings: Settings) -> list[str]:
    """Bring the stored sketch of every day that got rows up to Bronze; returns those days.

    A day's sketch is made anew from all its rows, as replaced rows cannot be taken out of one; other
    days are not read."""
    batch = next_batch(spark, settings, settings.bronze, "sketches")
    if batch is None:
        return []
    rows = stored_rows(spark, settings.bronze).where(F.col(KEY_DAY).isin(batch.days))
    replace_parts(spark, settings.day_sketches, day_sketches(rows, KEY_DAY))
    set_watermark(spark, settings.watermarks, "sketches", batch.high)
    return batch.days


def recalibrate_window(spark: SparkSession, settings: Settings, days: int) -> str:
    """Calibrate on the last ``days`` days and publish a new version; returns it.

    Reads one stored sketch a day, and no transfers but those of days that changed since the last
    time."""
    refresh_sketches(spark, settings)
    values = window_thresholds(read_table(spark, settings.day_sketches), days)
    version = publish_thresholds(spark, settings.thresholds, values, now_micros())
    log.info("published thresholds %s of %d days: %s", version, days, values)
    return version


def bootstrap_thresholds(spark: SparkSession, settings: Settings) -> str | None:
    """Publish a first version; does nothing (None) if one is active."""
    active = get_active_threshold(spark, settings.thresholds)
    if active is not None:
        log.info("thresholds %s are active", active.version)
        return None
    return recalibrate(spark, settings)


@dataclass(frozen=True)
class Batch:
    """Rows a layer has not processed yet, closed at both ends."""

    rows: DataFrame
    count: int
    high: int
    sizes: dict[str, int]  # rows of each of its days

    @property
    def days(self) -> list[str]:
        return list(self.sizes)


def next_batch(spark: SparkSession, settings: Settings, source, layer: str) -> Batch | None:
    """The next batch of a layer, or None if there are no rows.

    The log of ingests says which storage days rows above the mark can be in, so other days are not
    listed, whatever their files' times. One aggregate over two columns then gives emptiness, upper
    bound, row count and the days that do hold rows, by day.
    """
    mark = get_watermark(spark, settings.watermarks, layer)
    low = None if mark is None else instant(mark)
    stored = stored_rows(spark, source)
    if table_exists(spark, settings.ingest_days):
        ingests = read_table(spark, settings.ingest_days)
        written = [row[0] for row in days_after(ingests, low).collect()]
        stored = stored.where(F.col(KEY_DAY).isin(written))
    bounds = batch_bounds(rows_after(stored, low), KEY_DAY)
    found = bounds.withColumn("high", F.unix_micros("max_ingested_at")).collect()
    if not found:
        log.info("no new rows for %s", layer)
        return None
    sizes = {row[KEY_DAY]: row["batch_rows"] for row in found}
    high = max((row["high"] for row in found if row["high"] is not None), default=None)
    if high is None:
        raise WatermarkError(f"no ingest time to move the {layer} watermark to")
    rows = rows_after(stored, low, instant(high)).where(F.col(KEY_DAY).isin(list(sizes)))
    return Batch(rows, sum(sizes.values()), high, sizes)


def check_quality(scored: DataFrame, bronze_count: int) -> dict[str, float]:
    """Observed value per check; raises with all failed blocking checks at once."""
    return judge(quality_checks(quality_metrics(scored, bronze_count)).collect())


def judge(checks: list) -> dict[str, float]:
    failures = [
        f"{check['check_name']} = {check['observed']:.0f}"
        for check in checks
        if check["blocking"] and not check["passed"]
    ]
    if failures:
        raise QualityGateError(failures)
    return {check["check_name"]: check["observed"] for check in checks}


def score(spark: SparkSession, settings: Settings) -> int:
    """Score Bronze rows above the watermark into Silver; returns their number.

    The gate reads the columns it needs before anything is written. What it finds is kept with the
    batch's newest ingest instant, also if it fails; then neither Silver nor the watermark changes.
    """
    limits = get_active_threshold(spark, settings.thresholds)
    if limits is None:
        raise NoActiveThresholdsError(f"no active thresholds in {settings.threshold_table}")
    gone, days = _retracted(spark, settings, "silver")
    batch = next_batch(spark, settings, settings.bronze, "silver")
    if batch is None:
        remove_rows(spark, settings.silver, gone, days)
        return 0
    scored = to_silver(batch.rows, limits)
    checks = quality_checks(quality_metrics(scored, batch.count)).collect()
    _keep_results(spark, settings.gate_results, checks, batch.high)
    log.info("quality of the batch: %s", judge(checks))
    upsert(
        spark,
        settings.silver,
        scored,
        "transaction_id",
        batch.sizes,
        on_duplicate=settings.on_duplicate,
        gather=False,  # Bronze files hold one day each
        replayed=["ingested_at", "source_file"],
    )
    remove_rows(spark, settings.silver, gone, days)
    set_watermark(spark, settings.watermarks, "silver", batch.high)
    return batch.count


def _keep_results(spark: SparkSession, table, checks: list, checked_to: int) -> None:
    """What the gate found for a batch; a batch that is checked again replaces what it had."""
    results = spark.createDataFrame(checks).withColumn("checked_to", instant(checked_to))
    results = results.select(*table.schema.names)
    kept = read_or_empty(spark, table)
    if kept.where(F.col("checked_to") == instant(checked_to)).isEmpty():
        append(spark, table, results.coalesce(1))
    else:
        others = kept.where(F.col("checked_to") != instant(checked_to))
        overwrite(spark, table, others.unionByName(results))


def publish_gold(spark: SparkSession, settings: Settings) -> int:
    """Bring both snapshots and the alerts up to Silver; returns new Silver rows.

    Totals of the batch's days are counted anew from Silver and replaced; all others stay. Both
    snapshots roll up from the totals. The watermark moves after all outputs.
    """
    _, retracted = _retracted(spark, settings, "gold")
    batch = next_batch(spark, settings, settings.silver, "gold")
    days = sorted({*retracted, *(batch.days if batch else ())})
    if not days:
        return 0
    silver = stored_rows(spark, settings.silver)
    if table_exists(spark, settings.gold_totals):
        silver = silver.where(F.col(KEY_DAY).isin(days))
    replace_parts(spark, settings.gold_totals, gold.daily_totals(silver), retracted)
    totals = read_table(spark, settings.gold_totals)
    overwrite(spark, settings.gold_risk, gold.risk_effectiveness_from(totals))
    overwrite(spark, settings.gold_operational, gold.operational_from(totals))
    if batch is None:
        return 0

    found = gold.alerts(batch.rows, settings.alert_score, keep=(KEY_DAY,))
    upsert(
        spark,
        settings.gold_alerts,
        found,
        "transaction_id",
        batch.sizes,
        on_duplicate=settings.on_duplicate,
        replayed=[name for name in ALERTS.names if name != "transaction_id"],
    )
    set_watermark(spark, settings.watermarks, "gold", batch.high)
    return batch.count


def compact_tables(spark: SparkSession, settings: Settings) -> dict[str, list[str]]:
    """Rewrite days of the keyed tables that late batches left in many small files; returns them by
    table. Rows stay as they are, and so do watermarks."""
    return {
        table.name: compact(spark, table, settings.file_bytes, settings.files_per_bucket)
        for table in (settings.bronze, settings.silver, settings.gold_alerts)
    }


def use_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> None:
    """Keep the folder the session names in spark.checkpoint.dir. A session without one takes the
    caller's; without either there is no place that every executor is known to reach."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or folder
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        spark.sparkContext.setCheckpointDir(folder)


def run_daily(spark: SparkSession, settings: Settings) -> None:
    """Ingest, bootstrap, score, publish; a failing step stops the ones after it."""
    ingest(spark, settings)
    bootstrap_thresholds(spark, settings)
    score(spark, settings)
    publish_gold(spark, settings)
