"""Every operator as a query over the sample tables.

Control tables, which the sample lacks, are derived from ``events``: a calendar day stands for a
file, an event type for a layer, a week for a threshold version.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from dataclasses import replace

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.errors import CalibrationError, QualityGateError
from txrisk.functions.keys import key_day, transaction_key
from txrisk.functions.rules import Thresholds
from txrisk.operators import bronze, calibration, gold, quality, silver
from txrisk.operators.upsert import keep_last, matched_parts, merge_rows
from txrisk.plans import jobs, state
from txrisk.plans.settings import Settings
from txrisk.plans.state import calculate_thresholds
from txrisk.schemas import APPROX_ACCURACY, BRONZE, KEY_DAY, RAW, THRESHOLD_PERCENTILE, conform
from txrisk.sources import files
from txrisk.sources.tables import append, part_files, read_table, stored_rows
from txrisk.sources.tables import upsert as upsert_rows
from txrisk.sources.transfers import transfers
from txrisk.streaming import progress

LOADED_AT = "2024-06-01 12:30:00"
CLOSED_AT = "2024-02-01 03:00:00"
FILES_DONE_TO = "2024-01-15"
FILE_FAILED = "2024-01-20"
MARK = "2024-01-20 00:00:00"
TARGET_BEFORE = "2024-01-20 00:00:00"
SOURCE_FROM = "2024-01-10 00:00:00"
SECOND_BATCH_FROM = "2024-01-16 00:00:00"
RESENT_FROM = "2024-01-15 00:00:00"


def _clock(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _moment(text: str) -> Column:
    """That wall clock time in the session's zone, so results do not depend on the zone."""
    return F.lit(text).cast("timestamp")


def _kept_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transfers for a query that reads them several times: derived once and written below the session's
    checkpoint folder, in files of even size. Without such a folder they are derived at each use."""
    try:
        place = f"{_folder(spark)}/transfers"
    except ValueError:
        return transfers(spark, sf_dir)
    transfers(spark, sf_dir).write.parquet(place)
    return spark.read.parquet(place)


def _day_file() -> Column:
    return F.concat(F.lit("day="), F.to_date("event_time").cast("string"))


def _bronze(rows: DataFrame) -> DataFrame:
    return bronze.to_bronze(rows.withColumn(bronze.SOURCE_PATH, _day_file()), _moment(LOADED_AT))


def _limits(rows: DataFrame) -> Thresholds:
    values = calculate_thresholds(rows, exact=True)
    return Thresholds(*[values[name] for name in calibration.METRICS], "exact")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _kept_transfers(spark, sf_dir)
    return silver.to_silver(bronze.with_transaction_id(rows), _limits(rows))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# --- sources ---------------------------------------------------------------------------------


def list_files(spark, sf_dir):
    """Events written as files that hold whole days; what the listing and the scan say of each day."""
    folder = f"{_folder(spark)}/days"
    _events(spark, sf_dir).repartition(F.to_date("ts")).write.parquet(folder)
    listed = files.list_files(spark, folder)
    rows = files.scan_files(spark, [row.path for row in listed.collect()])
    found = rows.join(listed, F.col(bronze.SOURCE_PATH) == F.col("source_file"))
    return found.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_distinct("source_file").alias("file_count"),
        F.count_if(F.col("length") > 0).alias("row_count"),
        F.min("ts").alias("first_at"),
        F.max("ts").alias("last_at"),
    )


def scan_with_path(spark, sf_dir):
    """Transfers of even and odd seconds in files of different number types, read as one."""
    folder, even = _folder(spark), F.second("event_time") % 2 == 0
    rows = transfers(spark, sf_dir)
    rows.where(even).write.parquet(f"{folder}/double")
    rows.where(~even).withColumns(
        {"amount": F.col("amount").cast("decimal(18,2)"), "is_fraud": F.col("is_fraud").cast("bigint")}
    ).write.parquet(f"{folder}/decimal")
    paths = [
        row.path for kind in ("double", "decimal") for row in files.list_files(spark, f"{folder}/{kind}").collect()
    ]
    kept = (bronze.SOURCE_PATH,)
    found = files.scan_files(spark, paths, lambda raw: conform(raw, RAW, keep=kept))
    kind = F.regexp_extract(bronze.SOURCE_PATH, "/([^/]+)/[^/]+$", 1).alias("kind")
    return found.select("payer_id", "event_time", "amount", "is_fraud", kind)


def _file_log(spark, sf_dir):
    day = F.to_date("ts").cast("string")
    per_day = _events(spark, sf_dir).groupBy(day.alias("day")).agg(F.max("ts").alias("processed_at"))
    return per_day.where((F.col("day") <= FILES_DONE_TO) | (F.col("day") == FILE_FAILED)).select(
        F.concat(F.lit("day="), "day").alias("source_file"),
        "processed_at",
        F.when(F.col("day") == FILE_FAILED, "FAILED").otherwise("SUCCESS").alias("status"),
    )


def _listed_days(spark, sf_dir):
    day = F.concat(F.lit("day="), F.to_date("ts").cast("string"))
    return _events(spark, sf_dir).select(day.alias("source_file")).distinct()


def processed_files(spark, sf_dir):
    return files.processed_files(_file_log(spark, sf_dir))


def new_files(spark, sf_dir):
    return files.new_files(_listed_days(spark, sf_dir), processed_files(spark, sf_dir))


def file_log_rows(spark, sf_dir):
    rows = files.log_rows(new_files(spark, sf_dir), _moment(LOADED_AT))
    return rows.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


# --- bronze ----------------------------------------------------------------------------------


def transaction_id(spark, sf_dir):
    return bronze.with_transaction_id(transfers(spark, sf_dir)).select(
        "transaction_id", "payer_id", "payee_id", "tx_type", "event_time", "amount"
    )


def key_days(spark, sf_dir):
    return transfers(spark, sf_dir).select(transaction_key().alias("transaction_id"), key_day().alias(KEY_DAY))


def ingest_metadata(spark, sf_dir):
    raw = transfers(spark, sf_dir).withColumn(bronze.SOURCE_PATH, _day_file())
    return bronze.with_ingest_metadata(raw, _moment(LOADED_AT)).select(
        "payer_id",
        "event_time",
        "source_file",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        "ingested_date",
    )


def bronze_rows(spark, sf_dir):
    rows = _bronze(transfers(spark, sf_dir))
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")).select(*BRONZE.names)


# --- silver ----------------------------------------------------------------------------------


def time_features(spark, sf_dir):
    return silver.with_features(transfers(spark, sf_dir)).select(
        "payer_id", "event_time", "hour_of_day", "day_of_week", "is_weekday", "is_night"
    )


def balance_ratios(spark, sf_dir):
    return silver.with_features(transfers(spark, sf_dir)).select(
        "payer_id", "event_time", "residual_balance_ratio", "payee_amount_ratio"
    )


def rule_flags(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "transaction_id",
        "flag_night",
        "flag_night_high_amount",
        "flag_high_amount",
        "flag_residual_balance",
        "flag_payee_ratio",
    )


def score_level(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "risk_score", "risk_level")


def silver_rows(spark, sf_dir):
    kept = _kept_transfers(spark, sf_dir)
    rows = silver.to_silver(_bronze(kept), _limits(kept))
    return rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


# --- calibration -----------------------------------------------------------------------------


def thresholds_exact(spark, sf_dir):
    return calibration.exact_thresholds(_kept_transfers(spark, sf_dir))


def thresholds_approx_bound(spark, sf_dir):
    """Whether each approximate percentile lies within the sketch's rank error."""
    rows = _kept_transfers(spark, sf_dir)
    return _within_bound(rows, calibration.approximate_thresholds(rows).first())


def _within_bound(history, found):
    rows = calibration.calibration_input(history)

    def ranks(name, column):
        value, rank = F.col(column), F.ceil(F.count(column) * F.lit(float(THRESHOLD_PERCENTILE)))
        slack = F.count(column) / APPROX_ACCURACY + 1
        first = F.count_if(value < found[name]) + 1
        last = F.count_if(value <= found[name])
        return F.struct(
            F.lit(name).alias("metric"),
            F.count(column).alias("value_count"),
            ((rank >= first - slack) & (rank <= last + slack)).alias("within_bound"),
        ).alias(name)

    ranked = rows.agg(*[ranks(name, column) for name, column in calibration.METRICS.items()])
    return ranked.select(F.inline(F.array(*calibration.METRICS)))


def _history(spark, sf_dir):
    """One threshold version per week of events; the last one is open."""
    weeks = (
        silver.with_features(transfers(spark, sf_dir))
        .groupBy(F.date_trunc("week", "event_time").alias("week"))
        .agg(*[F.max(column).alias(name) for name, column in calibration.METRICS.items()])
    )
    last = weeks.agg(F.max("week")).scalar()
    return weeks.select(
        F.date_format("week", "yyyyMMdd").alias("threshold_version"),
        *calibration.METRICS,
        F.col("week").cast("timestamp").alias("valid_from"),
        F.when(F.col("week") != last, F.col("week") + F.expr("interval 7 days"))
        .cast("timestamp")
        .alias("valid_to"),
    )


def _plain_times(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


def active_threshold(spark, sf_dir):
    return _plain_times(calibration.active_threshold(_history(spark, sf_dir)))


def publish_thresholds(spark, sf_dir):
    """A version published on top of a stored history; its name, an instant, is given as 'new'."""
    table = _deploy(spark).thresholds
    append(spark, table, _history(spark, sf_dir))
    values = calculate_thresholds(_kept_transfers(spark, sf_dir), exact=True)
    state.publish_thresholds(spark, table, values, _micros(spark, CLOSED_AT))
    version = F.when(F.length("threshold_version") > 8, "new").otherwise(F.col("threshold_version"))
    return _plain_times(read_table(spark, table).withColumn("threshold_version", version))


def thresholds_exact_narrowed(spark, sf_dir):
    """The same percentiles with a range of at most 50 values, which takes several rounds."""
    return calibration.exact_thresholds(_kept_transfers(spark, sf_dir), max_rows=50)


def calibration_guard(spark, sf_dir):
    """What calibration refuses: per history and measure, its values and whether it is named."""
    whole = _kept_transfers(spark, sf_dir)
    none = F.lit(None).cast("double")
    histories = {
        "whole": whole,
        "no amounts": whole.withColumn("amount", none),
        "no payer balances": whole.withColumn("payer_balance_after", none),
        "before the first event": whole.where(F.col("event_time") < _clock("2000-01-01 00:00:00")),
    }
    found = None
    for name, rows in histories.items():
        try:
            calculate_thresholds(rows, exact=True)
            refused = ""
        except CalibrationError as error:
            refused = str(error)
        counts = calibration.calibration_input(rows).agg(
            *[
                F.struct(
                    F.lit(name).alias("history"),
                    F.lit(metric).alias("metric"),
                    F.count(column).alias("value_count"),
                    F.lit(metric in refused).alias("refused"),
                ).alias(metric)
                for metric, column in calibration.METRICS.items()
            ]
        )
        counts = counts.select(F.inline(F.array(*calibration.METRICS)))
        found = counts if found is None else found.unionByName(counts)
    return found


# --- quality ---------------------------------------------------------------------------------


def _metrics(spark, sf_dir):
    counted = transfers(spark, sf_dir).select(F.count("*")).scalar()
    return quality.quality_metrics(_scored(spark, sf_dir), counted)


def quality_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


def quality_gate(spark, sf_dir):
    return quality.quality_checks(_metrics(spark, sf_dir))


# --- gold ------------------------------------------------------------------------------------


def _rounded(df):
    return df.withColumn("amount_sum", F.round("amount_sum", 2))


def risk_effectiveness(spark, sf_dir):
    return _rounded(gold.risk_effectiveness(_scored(spark, sf_dir)))


def operational(spark, sf_dir):
    return _rounded(gold.operational(_scored(spark, sf_dir)))


def risk_effectiveness_from_base(spark, sf_dir):
    totals = gold.daily_totals(_scored(spark, sf_dir).withColumn(KEY_DAY, key_day()))
    return _rounded(gold.risk_effectiveness_from(totals))


def operational_from_base(spark, sf_dir):
    totals = gold.daily_totals(_scored(spark, sf_dir).withColumn(KEY_DAY, key_day()))
    return _rounded(gold.operational_from(totals))


def alerts(spark, sf_dir):
    return gold.alerts(_scored(spark, sf_dir))


# --- incremental state -----------------------------------------------------------------------


def _stamped(spark, sf_dir):
    return _events(spark, sf_dir).withColumnRenamed("ts", "ingested_at")


def batch_bounds(spark, sf_dir):
    return progress.batch_bounds(progress.rows_after(_stamped(spark, sf_dir), _clock(MARK)))


def _ingested_by_day(spark, sf_dir) -> Settings:
    """A Bronze table in which every day was ingested on its own, at its midnight."""
    deployed = _deploy(spark)
    at = F.date_trunc("day", "event_time").cast("timestamp")
    raw = transfers(spark, sf_dir).withColumn(bronze.SOURCE_PATH, _day_file())
    rows = bronze.to_bronze(raw, at, with_key_day=True)
    append(spark, deployed.bronze, rows)
    append(spark, deployed.ingest_days, rows.select("ingested_at", KEY_DAY).distinct())
    return deployed


def incremental_read(spark, sf_dir):
    """The next batch of a layer whose watermark is MARK, as the job reads it."""
    deployed = _ingested_by_day(spark, sf_dir)
    state.set_watermark(spark, deployed.watermarks, "silver", _micros(spark, MARK))
    batch = jobs.next_batch(spark, deployed, deployed.bronze, "silver")
    at = F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")
    return batch.rows.select("transaction_id", "event_time", "amount", at)


def empty_batch(spark, sf_dir):
    """Rows of the next batch, and whether the job finds it empty, for a mark before the end of the
    table and for the mark that its batch gives."""
    deployed = _ingested_by_day(spark, sf_dir)
    found, mark = [], _micros(spark, MARK)
    for name in ("before", "after"):
        state.set_watermark(spark, deployed.watermarks, "silver", mark)
        batch = jobs.next_batch(spark, deployed, deployed.bronze, "silver")
        found.append((name, 0 if batch is None else batch.count, batch is None))
        mark = mark if batch is None else batch.high
    return spark.createDataFrame(found, "mark string, batch_rows bigint, is_empty boolean")


def _event_marks(events):
    """Newest time of each event type, which stands for a layer: a few rows."""
    newest = events.groupBy("event_type").agg(F.max(F.col("ts").cast("timestamp")).alias("mark"))
    return [tuple(row) for row in newest.select("event_type", F.unix_micros("mark")).collect()]


def watermark_latest(spark, sf_dir):
    """Marks as a job reads them from a table with many rows a layer."""
    table, events = _deploy(spark).watermarks, _events(spark, sf_dir)
    at = F.col("ts").cast("timestamp")
    append(
        spark,
        table,
        events.select(
            F.col("event_type").alias("layer_name"),
            at.alias("last_ingestion_timestamp"),
            at.alias("updated_at"),
        ),
    )
    layers = [row[0] for row in events.select("event_type").distinct().collect()]
    marks = [(layer, state.get_watermark(spark, table, layer)) for layer in layers]
    return _named_marks(spark.createDataFrame(marks, "layer_name string, micros bigint"))


def _named_marks(marks):
    at = F.timestamp_micros("micros").cast("timestamp_ntz").alias("last_ingestion_timestamp")
    return marks.select("layer_name", at)


def set_watermark(spark, sf_dir):
    """Marks set by the job's function, some of them twice, as the table holds them."""
    table, events = _deploy(spark).watermarks, _events(spark, sf_dir)
    for part in (F.col("ts") < _clock(TARGET_BEFORE), F.col("event_type") != "view"):
        for layer, micros in _event_marks(events.where(part)):
            state.set_watermark(spark, table, layer, micros)
    micros = F.unix_micros("last_ingestion_timestamp").alias("micros")
    return _named_marks(read_table(spark, table).select("layer_name", micros))


# --- upsert ----------------------------------------------------------------------------------


def _keyed(spark, sf_dir):
    return bronze.with_transaction_id(transfers(spark, sf_dir)).select(
        key_day().alias(KEY_DAY), "transaction_id", "event_time", "amount", "is_fraud"
    )


def _target(spark, sf_dir):
    return _keyed(spark, sf_dir).where(F.col("event_time") < _clock(TARGET_BEFORE))


def _source(spark, sf_dir):
    later = _keyed(spark, sf_dir).where(F.col("event_time") >= _clock(SOURCE_FROM))
    return later.withColumn("is_fraud", 1 - F.col("is_fraud"))


def upsert(spark, sf_dir):
    return merge_rows(_target(spark, sf_dir), _source(spark, sf_dir), [KEY_DAY, "transaction_id"])


def upsert_matches(spark, sf_dir):
    return matched_parts(_target(spark, sf_dir), _source(spark, sf_dir), "transaction_id", KEY_DAY)


def upsert_keep_last(spark, sf_dir):
    """Every source row twice with different labels: the last in order is kept, then merged."""
    source = _source(spark, sf_dir)
    twice = source.unionByName(source.withColumn("is_fraud", 1 - F.col("is_fraud")))
    return merge_rows(
        _target(spark, sf_dir), keep_last(twice, "transaction_id"), [KEY_DAY, "transaction_id"]
    )


# --- jobs ------------------------------------------------------------------------------------


def _folder(spark) -> str:
    """A new folder below the session's checkpoint folder, which every executor can reach. Only a
    session without one that runs in one process, as in tests, gets a temporary one."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named and re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txrisk-"))
    jobs.use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/r{uuid.uuid4().hex}"


def _micros(spark, text: str) -> int:
    return spark.range(1).select(F.unix_micros(_moment(text))).first()[0]


def _deploy(spark) -> Settings:
    """Fresh tables in a new folder."""
    folder = _folder(spark)
    run = folder.rsplit("/", 1)[1]
    names = {
        f"{table}_table": f"{table}_{run}"
        for table in (
            "bronze silver control ingest_day file_version retraction watermark threshold gate_result day_sketch "
            "gold_total gold_risk gold_operational gold_alerts".split()
        )
    }
    return Settings(f"{folder}/raw", f"{folder}/tables", exact_thresholds=True, **names)


_PASSING = "amount > 0"


def _first_batch(rows):
    return rows.where(F.col("event_time") < _clock(SECOND_BATCH_FROM))


def _second_batch(rows):
    """Later transfers, and one day sent again with its labels turned around."""
    later = rows.where(F.col("event_time") >= _clock(SECOND_BATCH_FROM))
    resent = rows.where(
        (F.col("event_time") >= _clock(RESENT_FROM)) & (F.col("event_time") < _clock(SECOND_BATCH_FROM))
    ).withColumn("is_fraud", 1 - F.col("is_fraud"))
    return later.unionByName(resent)


def _after_two_days(spark, sf_dir) -> Settings:
    """Two daily runs, a third without new files, and one of the rows that the gate refuses (amounts
    not above zero), which come in a batch of their own. The last two change nothing."""
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows).where(_PASSING), deployed)
        jobs.run_daily(spark, deployed)
    jobs.run_daily(spark, deployed)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows).where(f"NOT {_PASSING}"), deployed)
    with contextlib.suppress(QualityGateError):
        jobs.run_daily(spark, deployed)
    return deployed


def _deliver(rows, deployed):
    rows.write.mode("append").parquet(deployed.source_path)


def refused_batch(spark, sf_dir):
    """A second batch with labels outside 0 and 1 and amounts of zero: what the gate says of it, and
    what Silver holds afterwards."""
    return _refused(spark, sf_dir)[1]


def gate_results(spark, sf_dir):
    """Blocking checks of a batch that passed and of one that was refused, as they are kept."""
    kept = read_table(spark, _refused(spark, sf_dir)[0].gate_results).where("blocking")
    batch = F.dense_rank().over(Window.partitionBy("check_name").orderBy("checked_to")).alias("batch")
    return kept.select(batch, "check_name", "observed", "passed")


def _refused(spark, sf_dir):
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    _deliver(_first_batch(rows).where(_PASSING), deployed)
    jobs.run_daily(spark, deployed)
    later = rows.where(F.col("event_time") >= _clock(SECOND_BATCH_FROM))
    bad = F.when(F.hour("event_time") == 3, 0.5).otherwise(F.col("is_fraud"))
    zero = F.when(F.hour("event_time") == 4, 0.0).otherwise(F.col("amount"))
    _deliver(later.withColumns({"is_fraud": bad, "amount": zero}), deployed)
    try:
        jobs.run_daily(spark, deployed)
        failures = []
    except QualityGateError as error:
        failures = [tuple(text.split(" = ")) for text in error.failures]
    found = spark.createDataFrame(failures, "check_name string, observed string")
    silver_rows = read_table(spark, deployed.silver).select(F.count("*")).scalar()
    found = found.select("check_name", F.col("observed").cast("bigint"), silver_rows.alias("silver_rows"))
    return deployed, found


def ingest_job(spark, sf_dir):
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest(spark, deployed)
    return read_table(spark, deployed.bronze).select("transaction_id", "event_time", "amount", "is_fraud")


def bootstrap_job(spark, sf_dir):
    """The second call, after a second batch, finds an active version and publishes nothing."""
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest(spark, deployed)
        jobs.bootstrap_thresholds(spark, deployed)
    return _versions(spark, deployed)


def bootstrap_job_approximate(spark, sf_dir):
    """The default calibration on what was ingested: values counted, and the rank bound kept."""
    deployed = replace(_deploy(spark), exact_thresholds=False)
    _deliver(transfers(spark, sf_dir), deployed)
    jobs.ingest(spark, deployed)
    jobs.bootstrap_thresholds(spark, deployed)
    found = calibration.active_threshold(read_table(spark, deployed.thresholds)).first()
    return _within_bound(read_table(spark, deployed.bronze), found)


def recalibrate_job(spark, sf_dir):
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest(spark, deployed)
        jobs.recalibrate(spark, deployed)
    return _versions(spark, deployed)


CHANGED_DAY = "2024-01-05"


def changed_file(spark, sf_dir):
    """The file of one day changed in place: it lacks the transfers of even seconds and has other labels
    for the rest. What Silver holds after the next daily run."""
    deployed = replace(_deploy(spark), reread_changed=True)
    rows = _first_batch(_kept_transfers(spark, sf_dir)).where(_PASSING)
    day = F.to_date("event_time") == F.lit(CHANGED_DAY).cast("date")
    _deliver(rows.where(day).coalesce(1), deployed)
    (old,) = [row.path for row in files.list_files(spark, deployed.source_path).collect()]
    _deliver(rows.where(~day), deployed)
    jobs.run_daily(spark, deployed)
    folder = f"{_folder(spark)}/version"
    later = rows.where(day & (F.second("event_time") % 2 == 1)).withColumn("is_fraud", 1 - F.col("is_fraud"))
    later.coalesce(1).write.parquet(folder)
    (new,) = [row.path for row in files.list_files(spark, folder).collect()]
    _replace_file(old, new)
    jobs.run_daily(spark, deployed)
    return read_table(spark, deployed.silver).select("transaction_id", "event_time", "amount", "is_fraud")


def _replace_file(old: str, new: str) -> None:
    """As a source would that writes a file again under its name; on local disks with no stale checksum."""
    system, place = fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", old))
    fs.copy_files(re.sub("^file:/*", "file:///", new), re.sub("^file:/*", "file:///", old))
    folder, name = place.rsplit("/", 1)
    if system.get_file_info(f"{folder}/.{name}.crc").type != fs.FileType.NotFound:
        system.delete_file(f"{folder}/.{name}.crc")


WINDOW_DAYS = 7


def window_thresholds(spark, sf_dir):
    """Thresholds of the last days after each of two deliveries, merged from stored sketches. Sketches
    hold so many values that at this size they are exact."""
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest(spark, deployed)
        jobs.recalibrate_window(spark, deployed, WINDOW_DAYS)
    return _versions(spark, deployed)


def day_sketches(spark, sf_dir):
    """What the stored sketches say of each day: values, and the amount at the percentile."""
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest(spark, deployed)
        jobs.refresh_sketches(spark, deployed)
    amount = F.kll_sketch_get_quantile_double("amount_sketch", F.lit(float(THRESHOLD_PERCENTILE)))
    return read_table(spark, deployed.day_sketches).select(
        KEY_DAY, "amount_count", "amount_nan", amount.alias("p95_amount")
    )


def stream_ingest(spark, sf_dir):
    """Two deliveries through the file stream, each by a new run on one checkpoint; a third run finds
    nothing new."""
    deployed, rows = _deploy(spark), _kept_transfers(spark, sf_dir)
    checkpoint = f"{_folder(spark)}/stream"
    for batch in (_first_batch, _second_batch):
        _deliver(batch(rows), deployed)
        jobs.ingest_stream(spark, deployed, checkpoint)
    if jobs.ingest_stream(spark, deployed, checkpoint):
        raise AssertionError("the stream took files twice")
    return read_table(spark, deployed.bronze).select("transaction_id", "event_time", "amount", "is_fraud")


def corrected_bucket(spark, sf_dir):
    """Transfers of one day sent again, into days of many buckets: which stored rows were written anew."""
    deployed = replace(_deploy(spark), bucket_rows=50)
    raw = _kept_transfers(spark, sf_dir).withColumn(bronze.SOURCE_PATH, _day_file())
    rows = bronze.to_bronze(raw, _moment(LOADED_AT), with_key_day=True)
    upsert_rows(spark, deployed.bronze, rows, "transaction_id")
    before = _place_of_rows(spark, deployed).alias("before")
    kept = before.checkpoint()
    resent = rows.where((F.to_date("event_time") == F.lit(FILES_DONE_TO).cast("date")) & F.col("transaction_id").startswith("a"))
    upsert_rows(spark, deployed.bronze, resent.withColumn("is_fraud", 1 - F.col("is_fraud")), "transaction_id")
    after = _place_of_rows(spark, deployed).alias("after")
    moved = F.col("before.file") != F.col("after.file")
    return kept.alias("before").join(after, "transaction_id").select(
        "transaction_id", F.col("after.is_fraud").alias("is_fraud"), moved.alias("rewritten")
    )


def _place_of_rows(spark, deployed):
    return stored_rows(spark, deployed.bronze).select(
        "transaction_id", "is_fraud", F.col("_metadata.file_path").alias("file")
    )


def compacted_days(spark, sf_dir):
    """Ten late batches that all reach into the same days, then compaction: rows of each day, and
    whether its files are as few as a compacted day's."""
    deployed, rows = replace(_deploy(spark), files_per_bucket=2), _kept_transfers(spark, sf_dir)
    for late in range(10):
        _deliver(rows.where(F.pmod(F.xxhash64("payer_id", "event_time"), F.lit(10)) == late), deployed)
        jobs.ingest(spark, deployed)
    jobs.compact_tables(spark, deployed)
    found = part_files(spark, deployed.bronze)
    return found.select(KEY_DAY, F.col("rows").alias("row_count"), (F.col("files") <= 2).alias("few_files"))


def _versions(spark, deployed):
    rows = read_table(spark, deployed.thresholds)
    return rows.select(*calibration.METRICS, F.col("valid_to").isNull().alias("is_active"))


def score_job(spark, sf_dir):
    deployed = _after_two_days(spark, sf_dir)
    return read_table(spark, deployed.silver).select(
        "transaction_id", "amount", "is_fraud", "risk_score", "risk_level"
    )


def gold_job_risk(spark, sf_dir):
    return _rounded(read_table(spark, _after_two_days(spark, sf_dir).gold_risk))


def gold_job_operational(spark, sf_dir):
    return _rounded(read_table(spark, _after_two_days(spark, sf_dir).gold_operational))


def daily_jobs_alerts(spark, sf_dir):
    rows = read_table(spark, _after_two_days(spark, sf_dir).gold_alerts)
    return rows.drop("threshold_version")


QUERIES = {
    query.__name__: query
    for query in (
        list_files,
        scan_with_path,
        processed_files,
        new_files,
        file_log_rows,
        transaction_id,
        key_days,
        ingest_metadata,
        bronze_rows,
        time_features,
        balance_ratios,
        rule_flags,
        score_level,
        silver_rows,
        thresholds_exact,
        thresholds_exact_narrowed,
        thresholds_approx_bound,
        calibration_guard,
        active_threshold,
        publish_thresholds,
        quality_metrics,
        quality_gate,
        risk_effectiveness,
        operational,
        risk_effectiveness_from_base,
        operational_from_base,
        alerts,
        batch_bounds,
        incremental_read,
        empty_batch,
        watermark_latest,
        set_watermark,
        upsert,
        upsert_matches,
        upsert_keep_last,
        ingest_job,
        stream_ingest,
        changed_file,
        corrected_bucket,
        compacted_days,
        day_sketches,
        window_thresholds,
        bootstrap_job,
        bootstrap_job_approximate,
        recalibrate_job,
        refused_batch,
        gate_results,
        score_job,
        gold_job_risk,
        gold_job_operational,
        daily_jobs_alerts,
    )
}
