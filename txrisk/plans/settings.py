"""Where a deployment keeps its files and tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from txrisk import schemas
from txrisk.sources.tables import Table


@dataclass(frozen=True)
class Settings:
    """Table names may be qualified. With ``location`` set, each table lives in a directory of
    shared storage below it and later sessions find it there; without, tables are managed.

    ``source_columns`` names the raw columns of the source files where they differ from ours.
    ``gather_source=False`` stores source rows without a shuffle; choose it if each source file
    holds only a few days. New files are ingested ``files_per_batch`` at a time, until none is left.
    With ``reread_changed`` a file whose length or modification time is new is ingested again, and rows
    that only its earlier version had are taken out of Bronze, Silver and the snapshots.
    A stored day is divided into buckets of about ``bucket_rows`` rows, by its rows when it is first
    stored; a bucket is what a correction rewrites. ``compact_tables`` rewrites days that have more than
    ``files_per_bucket`` files to a bucket beyond what files of ``file_bytes`` ask for.
    """

    source_path: str
    location: str | None = None
    bronze_table: str = "bronze_transfers"
    silver_table: str = "silver_transfers"
    control_table: str = "ingested_files"
    ingest_day_table: str = "ingest_days"
    file_version_table: str = "file_versions"
    retraction_table: str = "retractions"
    watermark_table: str = "layer_watermarks"
    gate_result_table: str = "gate_results"
    threshold_table: str = "risk_thresholds"
    day_sketch_table: str = "day_sketches"
    gold_total_table: str = "gold_totals"
    gold_risk_table: str = "gold_risk_effectiveness"
    gold_operational_table: str = "gold_operational"
    gold_alerts_table: str = "gold_alerts"
    alert_score: int = schemas.ALERT_SCORE
    exact_thresholds: bool = False
    on_duplicate: str = "merge"
    gather_source: bool = True
    files_per_batch: int = 1_000
    reread_changed: bool = False
    bucket_rows: int = schemas.BUCKET_ROWS
    file_bytes: int = 256 << 20
    files_per_bucket: int = 4
    source_columns: Mapping[str, str] = field(default_factory=dict)

    def _table(self, name: str, schema, part: str | None = None) -> Table:
        place = f"{self.location.rstrip('/')}/{name.replace('.', '/')}" if self.location else None
        return Table(name, schema, part, place)

    def _keyed(self, name: str, schema) -> Table:
        table = self._table(name, schema, schemas.KEY_DAY)
        return replace(table, key="transaction_id", bucket_rows=self.bucket_rows)

    @property
    def bronze(self) -> Table:
        return self._keyed(self.bronze_table, schemas.BRONZE)

    @property
    def silver(self) -> Table:
        return self._keyed(self.silver_table, schemas.SILVER)

    @property
    def control(self) -> Table:
        return self._table(self.control_table, schemas.INGESTED_FILES)

    @property
    def ingest_days(self) -> Table:
        return self._table(self.ingest_day_table, schemas.INGEST_DAYS)

    @property
    def file_versions(self) -> Table:
        return self._table(self.file_version_table, schemas.FILE_VERSIONS)

    @property
    def retractions(self) -> Table:
        return self._table(self.retraction_table, schemas.RETRACTIONS)

    @property
    def watermarks(self) -> Table:
        return self._table(self.watermark_table, schemas.LAYER_WATERMARKS, "layer_name")

    @property
    def gate_results(self) -> Table:
        return self._table(self.gate_result_table, schemas.GATE_RESULTS)

    @property
    def thresholds(self) -> Table:
        return self._table(self.threshold_table, schemas.RISK_THRESHOLDS, "threshold_version")

    @property
    def day_sketches(self) -> Table:
        return self._table(self.day_sketch_table, schemas.DAY_SKETCHES, schemas.KEY_DAY)

    @property
    def gold_totals(self) -> Table:
        return self._table(self.gold_total_table, schemas.GOLD_TOTALS, schemas.KEY_DAY)

    @property
    def gold_risk(self) -> Table:
        return self._table(self.gold_risk_table, schemas.RISK_EFFECTIVENESS)

    @property
    def gold_operational(self) -> Table:
        return self._table(self.gold_operational_table, schemas.OPERATIONAL)

    @property
    def gold_alerts(self) -> Table:
        return self._keyed(self.gold_alerts_table, schemas.ALERTS)
