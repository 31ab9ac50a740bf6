"""Folders every executor reaches, tables that cut lineage, and reads of the given tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a Python worker is given at once, unless the session asks for fewer.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole documents, or pairs of their sets, are long rows: the session's default of 10,000 of
    them is too much for a worker. A lower setting stays."""
    rows = int(spark.conf.get(_BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the session names in spark.checkpoint.dir. Only a session
    without one that runs in one process, as in tests, gets a temporary folder."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        folder = tempfile.mkdtemp(prefix="txrisk-llm-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hash_sample(df: DataFrame, rows: int, seed: str, *keys: str) -> DataFrame:
    """At most `rows` rows of df in the order of a hash of their keys, the same ones in every run.

    A cut by other bits of the hash that leaves a fifth more comes first, so that not every task puts
    forward as many rows as the sample may have."""
    place = F.xxhash64(F.lit(seed), *keys)
    count, scale = df.count(), 1 << 40
    if count > rows:
        df = df.where(F.pmod(place, F.lit(scale)) < int(scale * min(1.0, 1.2 * rows / count)))
    return df.orderBy(place, *keys).limit(rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: a lost executor repeats no work
    before this point."""
    small_batches(df.sparkSession)
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
