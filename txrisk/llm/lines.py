"""Lines that many documents share, counted in levelled sorted runs of line hashes.

Documents go in batches. A batch's lines become hashes with the number of its documents that hold
them. Hashes already known to be frequent are taken out by a merge anti-join with the run of frequent
ones; the rest is the batch's own run, sorted by hash. When a level has FANOUT runs they are
compacted: a merge adds up their counts, hashes that reach the limit move to a frequent run, and the
others become one run of the next level. Only hashes are ever merged; texts are read three times and
shuffled once, to meet the places of the lines that go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, stored

#: A line in so many documents goes; keys of fewer code points never do.
DOCUMENTS, CODE_POINTS = 10, 1
#: Text in a batch, and batches at least, so that small tables take the same way as large ones.
BATCH_BYTES, BATCHES = 1 << 40, 4
#: Runs of a level that are merged into one of the next.
FANOUT = 3
#: Text that a file of a run stands for; its line hashes are a fraction of it.
FILE_BYTES = 256 << 20
_SPACE = " \t\n\x0b\x0c\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def _lowered(line: Column) -> Column:
    """A-Z lowered, nothing else. Lowering as such is the same for ASCII, and much faster than a
    translation by character."""
    lowered = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(lowered)


def _digest(text: Column) -> Column:
    """128 bits of the SHA-256, as hex: lines that differ do not meet, also if they were made to."""
    return F.substring(F.sha2(text, 256), 1, 32)


class Runs:
    """Runs of (hash, documents) by level, and runs of the hashes that reached the limit.

    A run is a folder of files dealt by hash and sorted by it. It is complete before anything refers
    to it, and never changed.
    """

    def __init__(self, spark: SparkSession, files: int, limit: int, fanout: int = FANOUT) -> None:
        self.spark, self.files, self.limit, self.fanout = spark, files, limit, fanout
        self.levels: list[list[str]] = []
        self.frequent: list[str] = []

    def _write(self, rows: DataFrame, name: str) -> str:
        path = new_folder(self.spark, name)
        rows.repartition(self.files, "hash").sortWithinPartitions("hash").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("hash binary, documents bigint").parquet(*paths)

    def add(self, batch: DataFrame) -> None:
        """A batch's (hash, documents): what no run knows as frequent becomes a run of level 0."""
        if self.frequent:
            known = self._read(self.frequent).select("hash").hint("merge")
            batch = batch.join(known, "hash", "left_anti")
        self._put(0, self._write(batch.select("hash", "documents"), "line-run"))

    def _put(self, level: int, path: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            paths, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._compact(paths))

    def _compact(self, paths: list[str]) -> str:
        """Merges runs: frequent hashes become a run of their own, the rest is returned as one."""
        merged = stored(
            self._read(paths).groupBy("hash").agg(F.sum("documents").alias("documents")), "line-merge"
        )
        reached = F.col("documents") >= self.limit
        self.frequent.append(self._write(merged.where(reached), "frequent-run"))
        return self._write(merged.where(~reached), "line-run")

    def all_frequent(self) -> DataFrame:
        """(hash) of every line in `limit` documents or more, after a last merge over all levels."""
        paths = [path for level in self.levels for path in level]
        if paths:
            self.levels = [[self._compact(paths)]]
        return self._read(self.frequent).select("hash").distinct()


def _ident() -> Column:
    """Rows of one doc_id and text have one name, as all their lines are equal."""
    name = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))
    )
    return F.unhex(_digest(name))


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(_ident().alias("ident"), F.coalesce("text", F.lit("")).alias("text"))


def _line_hashes(text: Column, code_points: int) -> Column:
    """The hash of every line's key in order, null where that is too short to count. What makes lines
    equal is the line without white space at both ends, A-Z lowered; a step at a time, so that
    each is worked out once."""
    keys = F.transform(F.transform(F.split(text, "\n", -1), _trimmed), _lowered)
    return F.transform(keys, lambda key: F.when(F.length(key) >= code_points, _digest(key)))


def count_lines(docs: DataFrame, code_points: int, batches: int) -> DataFrame:
    """(batch, hash, documents) on shared storage: a document counts once for each of its lines."""
    rows = _identified(docs)
    found = rows.select(
        F.pmod(F.xxhash64("ident"), F.lit(batches)).cast("int").alias("batch"),
        F.explode(F.array_distinct(_line_hashes(F.col("text"), code_points))).alias("hash"),
    ).where("hash IS NOT NULL")
    counts = found.select("batch", F.unhex("hash").alias("hash")).groupBy("batch", "hash")
    path = new_folder(docs.sparkSession, "line-counts")
    counts.agg(F.count("*").alias("documents")).write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema("hash binary, documents bigint, batch int").parquet(path)


def frequent_lines(docs: DataFrame, documents: int = DOCUMENTS, code_points: int = CODE_POINTS) -> DataFrame:
    """(hash) of the lines of docs (doc_id, text) that at least so many documents hold."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(BATCHES, -(-size // BATCH_BYTES))
    counts = count_lines(docs, code_points, batches)
    runs = Runs(spark, max(4, -(-size // FILE_BYTES)), documents)
    for batch in range(batches):
        runs.add(counts.where(F.col("batch") == batch).select("hash", "documents"))
    return stored(runs.all_frequent(), "frequent-lines")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts, dropped = [], [], []
        for text, positions in zip(batch.column(1), batch.column(2)):
            text, gone = text.as_py() or "", frozenset(positions.as_py() or ())
            if gone:
                lines = text.split("\n")
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
            else:
                kept.append(text)
            counts.append(text.count("\n") + 1)
            dropped.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
            ["rest", "text", "n_lines", "n_dropped"],
        )


def without_shared_lines(
    docs: DataFrame, documents: int = DOCUMENTS, code_points: int = CODE_POINTS
) -> DataFrame:
    """(rest, text, n_lines, n_dropped): docs without the lines that at least so many of them hold.

    Texts are split at newlines; a null or empty text is one empty line. A line's key is the line
    without white space at both ends, A-Z lowered; keys of fewer code points than `code_points` are
    never dropped. Lines whose key occurs in `documents` documents or more go everywhere, the others
    stay as they are, joined by newlines. A document counts once however often it holds a line; rows
    of one doc_id (or without one) are documents of their own, each counted. Other columns are in `rest`,
    under their names. An empty table gives no rows. Texts of any length are whole.

    Only (document, place) of dropped lines are grouped by document, never more than its lines; a
    line that very many documents hold is counted before it is shuffled, and its places meet
    the short list of frequent lines on the side that adaptive execution may split.
    """
    frequent = frequent_lines(docs, documents, code_points)
    places = _identified(docs).select(
        "ident", F.posexplode(_line_hashes(F.col("text"), code_points)).alias("place", "hash")
    )
    places = places.where("hash IS NOT NULL").select("ident", "place", F.unhex("hash").alias("hash"))
    hits = (
        places.join(frequent, "hash", "left_semi")
        .groupBy("ident")
        .agg(F.collect_set("place").alias("places"))
    )
    others = [c for c in docs.columns if c not in ("text",)]
    rows = docs.select(
        F.struct(*others).alias("rest"), "text", _ident().alias("_ident")
    )
    joined = rows.join(hits, rows["_ident"] == hits["ident"], "left").select("rest", "text", "places")
    kind = joined.schema["rest"].dataType.simpleString()
    return joined.mapInArrow(_without, f"rest {kind}, text string, n_lines bigint, n_dropped bigint")


def digest(dropped: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of `without_shared_lines`."""
    return dropped.select(
        "rest.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )
