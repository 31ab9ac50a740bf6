"""Raw Parquet files: listing, what is new, scan, and the log of finished files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txrisk.errors import MissingColumnsError
from txrisk.operators.bronze import SOURCE_PATH
from txrisk.schemas import FILE_DONE

_PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
_MAX_LIST_TASKS = 1_000
_FOOTER_THREADS = 16
_FOOTERS_PER_TASK, _MAX_FOOTER_TASKS = 16, 256
_URI_PREFIX = "^[^:/]+:(//[^/]*)?"


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Parquet files directly in ``directory``: ``source_file, path, length, modified_at``.

    ``source_file`` is the URI that a scan reports as ``_metadata.file_path``; ``path`` is the
    form a reader opens (the two differ where a name needs escaping). File contents are not
    read. ``directory`` must be absolute, or a full URI.
    """
    depth = _depth(directory)
    listed = (
        spark.read.format("binaryFile")
        # Recursive so that names like a=b below it are not taken for partitions.
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _PARQUET_GLOB)
        .load(directory)
        # Large files would make one task each, for one status request.
        .coalesce(_MAX_LIST_TASKS)
    )
    return _at_depth(listed, depth)


def _depth(directory: str) -> int:
    location = re.sub(_URI_PREFIX, "", directory)
    if location == directory and not directory.startswith("/"):
        raise ValueError(f"source directory must be absolute: {directory}")
    return len([step for step in location.split("/") if step]) + 1


def _at_depth(listed: DataFrame, depth: int) -> DataFrame:
    steps = F.split(F.regexp_replace("path", _URI_PREFIX, ""), "/+")
    return listed.where(F.size(F.array_remove(steps, "")) == depth).select(
        F.col("_metadata.file_path").alias("source_file"),
        "path",
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def stream_files(spark: SparkSession, directory: str, files_per_batch: int) -> DataFrame:
    """``list_files`` as a stream of files, so many to a batch; contents are not read."""
    depth = _depth(directory)
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _PARQUET_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
    )
    return _at_depth(stream, depth)


def processed_files(log: DataFrame) -> DataFrame:
    """Distinct files that finished; a file logged with any other status may come back."""
    return log.where(F.col("status") == FILE_DONE).select("source_file").distinct()


def new_files(listed: DataFrame, processed: DataFrame) -> DataFrame:
    return listed.join(processed, "source_file", "left_anti")


def new_versions(listed: DataFrame, versions: DataFrame) -> DataFrame:
    """Files that are new, or have another length or modification time than any version seen so far."""
    return listed.join(versions, ["source_file", "length", "modified_at"], "left_anti")


def _footer_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives for each path what two files of one schema have in common in their
    footers; NULL for a file that cannot be opened there, whatever the reason: Spark's reader has the
    last word on it. It goes to the tasks whole, so they need nothing of this package."""
    spark_schema = b"org.apache.spark.sql.parquet.row.metadata"

    def mark(path: str) -> str | None:
        try:
            if path.startswith(("file:", "/")):
                system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            else:
                system, place = fs.FileSystem.from_uri(path)
            with system.open_input_file(place) as file:
                footer = parquet.ParquetFile(file).metadata
        except (OSError, pa.ArrowException, ValueError):
            return None
        columns = str(footer.schema).split("\n", 1)[1].encode()
        return hashlib.sha256(columns + b"|" + (footer.metadata or {}).get(spark_schema, b"")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [mark(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], ["path", "mark"])

    return run


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files by the schema in their footers, in order of their first file; the paths are literal.

    Footers are read in the tasks of one job, and Spark is asked for the schema of one file of each kind,
    so the number of jobs depends on how many schemas there are, not on how many files. Only a file
    that the tasks cannot open (a store that only Spark's readers know, or a broken file, which
    Spark then names) is asked for by itself.
    """
    tasks = max(1, min(_MAX_FOOTER_TASKS, len(paths) // _FOOTERS_PER_TASK))
    rows = spark.createDataFrame([(path,) for path in paths], "path string").repartition(tasks)
    marks = dict(rows.mapInArrow(_footer_reader(), "path string, mark string").collect())
    first: dict[str, str] = {}
    for path in paths:
        first.setdefault(marks[path] or path, path)
    with ThreadPoolExecutor(_FOOTER_THREADS) as pool:
        schemas = dict(zip(first, pool.map(lambda path: spark.read.parquet(_literal(path)).schema, first.values())))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path in paths:
        schema = schemas[marks[path] or path]
        groups.setdefault(schema.json(), (schema, []))[1].append(_literal(path))
    return list(groups.values())


def _literal(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def scan_files(
    spark: SparkSession,
    paths: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Rows of exactly these files, each with the URI of its file, after ``prepare``.

    Files are read by the schema of their own footer, so a column that one of them lacks is never
    made up: ``prepare`` sees the files of one schema at a time, and what it says about missing
    columns names the files. Its results must have the same columns.
    """
    found = None
    for schema, group in schema_groups(spark, paths):
        rows = spark.read.schema(schema).parquet(*group)
        rows = rows.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
        try:
            rows = prepare(rows)
        except MissingColumnsError as error:
            more = f" and {len(group) - 1} more" if len(group) > 1 else ""
            raise MissingColumnsError(f"{error} (in {group[0]}{more})") from error
        found = rows if found is None else found.unionByName(rows)
    return found


def log_rows(files: DataFrame, at: Column) -> DataFrame:
    """Log entries for files whose rows are safely stored."""
    return files.select(
        "source_file", at.alias("processed_at"), F.lit(FILE_DONE).alias("status")
    )
