"""Headline timings as one JSON line: one warm-up, then the median of several runs.

BENCH_SF_DIR names the sample tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txrisk.functions.instants import instant, now_micros
from txrisk.functions.rules import Thresholds
from txrisk.operators import calibration, gold, silver
from txrisk.operators.bronze import SOURCE_PATH, to_bronze
from txrisk.plans import jobs
from txrisk.plans.settings import Settings
from txrisk.plans.state import calculate_thresholds
from txrisk.sources.tables import append, upsert
from txrisk.sources.transfers import transfers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("txrisk bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-bench-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs.use_checkpoint_dir(spark, tempfile.mkdtemp(prefix="run-bench-", dir="/tmp"))
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def deployment(spark: SparkSession) -> Settings:
    name = f"b{uuid.uuid4().hex}"
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    tables = (
        "bronze silver control ingest_day watermark threshold gate_result day_sketch "
        "gold_total gold_risk gold_operational gold_alerts"
    ).split()
    return Settings(
        f"{folder}/raw", f"{folder}/tables", **{f"{table}_table": f"{table}_{name}" for table in tables}
    )


def measure(action, prepare=lambda: None, runs: int = RUNS) -> float:
    """Median seconds of ``action`` over fresh results of ``prepare``, which is not timed."""
    seconds = []
    for _ in range(runs + 1):
        ready = prepare()
        start = time.perf_counter()
        action(ready)
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    spark = session()
    # Raw transfer files, as a deployment would receive them; the gate refuses amounts of zero.
    given = f"{spark.sparkContext.getCheckpointDir()}/given"
    transfers(spark, SF_DIR).where(F.col("amount") > 0).write.parquet(given)
    raw = spark.read.parquet(given)

    def scored_snapshot(exact: bool):
        values = calculate_thresholds(raw, exact)
        limits = Thresholds(*[values[name] for name in calibration.METRICS], "bench")
        run(gold.risk_effectiveness(silver.to_silver(raw, limits)))

    keyed = to_bronze(raw.withColumn(SOURCE_PATH, F.lit("bench")), instant(now_micros()), with_key_day=True)
    split = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    overlap = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")

    def stored():
        place = deployment(spark)
        append(spark, place.bronze, keyed.where(F.col("event_time") < split))
        return place

    def merge(place, source):
        upsert(spark, place.bronze, source, "transaction_id")

    def fed():
        place = deployment(spark)
        raw.write.parquet(place.source_path)
        return place

    def finished():
        place = fed()
        jobs.run_daily(spark, place)
        return place

    few = max(RUNS - 2, 1)
    timings = {
        "score_snapshot_exact": measure(lambda _: scored_snapshot(exact=True)),
        "score_snapshot_approx": measure(lambda _: scored_snapshot(exact=False)),
        "calibrate_exact": measure(lambda _: run(calibration.exact_thresholds(raw))),
        "calibrate_approx": measure(lambda _: run(calibration.approximate_thresholds(raw))),
        "upsert_append": measure(
            lambda place: merge(place, keyed.where(F.col("event_time") >= split)), stored, few
        ),
        "upsert_rewrite": measure(
            lambda place: merge(place, keyed.where(F.col("event_time") >= overlap)), stored, few
        ),
        "upsert_one_correction": measure(lambda place: merge(place, keyed.where(F.col("event_time") < split).limit(1)), stored, few),
        "calibrate_exact_narrowed": measure(lambda _: run(calibration.exact_thresholds(raw, max_rows=50))),
        "daily_first_batch": measure(lambda place: jobs.run_daily(spark, place), fed, few),
        "daily_replay": measure(lambda place: jobs.run_daily(spark, place), finished, few),
    }
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
