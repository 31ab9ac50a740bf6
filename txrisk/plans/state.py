"""Reads and writes of the control tables that jobs steer by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.errors import CalibrationError
from txrisk.functions.instants import instant, to_datetime
from txrisk.functions.rules import Thresholds
from txrisk.operators.calibration import (
    METRICS,
    active_threshold,
    approximate_thresholds,
    close_versions,
    exact_thresholds,
    merged_sketches,
    new_version,
    sketched_thresholds,
    window,
)
from txrisk.schemas import KEY_DAY, VERSION_FORMAT
from txrisk.sources.tables import Table, append, read_or_empty, read_table, replace_parts, table_exists
from txrisk.streaming.progress import latest_watermarks


def get_watermark(spark: SparkSession, table: Table, layer: str) -> int | None:
    """The layer's newest mark in microseconds, None before its first batch."""
    if not table_exists(spark, table):
        return None
    marks = read_or_empty(spark, table).where(F.col("layer_name") == layer)
    row = latest_watermarks(marks).select(F.unix_micros("last_ingestion_timestamp")).first()
    return row[0] if row else None


def set_watermark(spark: SparkSession, table: Table, layer: str, micros: int) -> None:
    """Set a layer's mark. A layer is its own part, so replacing the part is the upsert."""
    row = spark.range(1).select(
        F.lit(layer).alias("layer_name"),
        instant(micros).alias("last_ingestion_timestamp"),
        F.current_timestamp().alias("updated_at"),
    )
    replace_parts(spark, table, row)


def get_active_threshold(spark: SparkSession, table: Table) -> Thresholds | None:
    row = active_threshold(read_or_empty(spark, table)).first()
    return Thresholds(*[row[name] for name in METRICS], row["threshold_version"]) if row else None


def calculate_thresholds(bronze: DataFrame, exact: bool = False) -> dict[str, float]:
    """Calibrated values by name; fails where the history gives none."""
    return _complete((exact_thresholds if exact else approximate_thresholds)(bronze))


def window_thresholds(sketched: DataFrame, days: int) -> dict[str, float]:
    """Values calibrated on stored sketches of the last days; fails where they hold none."""
    return _complete(sketched_thresholds(merged_sketches(window(sketched, KEY_DAY, days))))


def _complete(found: DataFrame) -> dict[str, float]:
    values = found.first().asDict()
    empty = [name for name, value in values.items() if value is None]
    if empty:
        raise CalibrationError(f"no history to calibrate {', '.join(empty)} from")
    return values


def publish_thresholds(spark: SparkSession, table: Table, values: dict[str, float], micros: int) -> str:
    """Add a new open version, then close the ones before it; returns its version.

    The newest open version is the active one, so at no moment is none active, also if the job
    is lost between the two writes: the next publication closes whatever is open. A version is
    its own part, so closed versions are neither read nor rewritten.
    """
    version = to_datetime(micros).strftime(VERSION_FORMAT)
    at = instant(micros)
    row = new_version(spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()]), version, at)
    has_history = table_exists(spark, table)
    append(spark, table, row)
    if has_history:
        still_open = F.col("valid_to").isNull() & (F.col("threshold_version") != version)
        replace_parts(spark, table, close_versions(read_table(spark, table).where(still_open), at))
    return version
