"""Catalog tables on Parquet: create, read, append, replace parts, upsert, compact.

A keyed table is partitioned by a column that two rows of one key always share (a day), and each of
its parts by leading digits of the key into buckets, as many as its rows ask for. An upsert then reads
and rewrites only the buckets where keys match, and appends everything else; the rest of the table is
not touched.

A bucket has a folder of its own, unless there are very many small ones: folders then hold all buckets of
a part that begin with the same digits, and their names say how many digits a bucket has ("a~~" holds a00 to aff).
Buckets of such a folder are rewritten into a layer of it, a folder named by the swap ("a~~.swap"), and a row
of masks for each says that its rows in earlier layers are no longer the table's. Only readers that come
through ``stored_rows`` leave those out.

Nothing is ever replaced in place. New files go to a place of their own, a line in the table's swap log
says which parts move there, and then the catalog is told. A failure before the line leaves the old rows;
after it, the next write of the table, or the next session that opens it, finishes the move. So readers
see the old files of a part or the new ones, never none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txrisk.errors import DuplicateKeyError, MissingTableError
from txrisk.functions.instants import now_micros
from txrisk.operators.upsert import (
    duplicate_keys,
    keep_last,
    matched_keys,
    matched_parts,
    merge_rows,
    without_stored,
)
from txrisk.schemas import BUCKET_ROWS, KEY_BUCKET

#: The bucket of a part that is not divided.
UNDIVIDED = "all"
_MOST_DIGITS = 4
#: Where the new parts of a write have more buckets than these, small ones share folders of about so many rows.
_OWN_FOLDERS, _FOLDER_ROWS = 1_024, 100_000
#: What a common folder's name has for the digits in which its buckets differ, and before a layer's swap.
_MORE, _LAYER = "~", "."
_FOLDER = f"substring_index({KEY_BUCKET}, '{_LAYER}', 1)"
#: Source rows above which an upsert's joins shuffle both sides, some 5 MB of keys. Files say little of the
#: size of keys derived from them, so Spark would send far more than its limit through the driver.
_SENT_ROWS = 50_000
_APPLIED = "txrisk.swaps"
_LISTING, _LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4
_MASK = StructType([StructField("_bucket", StringType()), StructField("_layer", StringType())])
_SWAP = StructType([StructField(name, StringType()) for name in ("swap", "part", "place")])
#: The directory of rows without a part.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """A table's name, contract, part column (if any) and directory (if not managed).

    ``key`` names a column of hexadecimal digits; parts are then divided by its leading digits into
    buckets of about ``bucket_rows`` rows.
    """

    name: str
    schema: StructType
    part: str | None = None
    location: str | None = None
    key: str | None = None
    bucket_rows: int = BUCKET_ROWS

    @property
    def parts(self) -> list[str]:
        """The partition columns."""
        return [name for name in (self.part, KEY_BUCKET if self.key else None) if name]

    @property
    def columns(self) -> list[str]:
        """Physical column order: the partition columns come last."""
        own = [name for name in self.schema.names if name not in self.parts]
        return own + self.parts

    @property
    def types(self) -> StructType:
        fields = {f.name: f for f in self.schema}
        return StructType([fields.get(name, StructField(name, StringType())) for name in self.columns])


# --- existence -------------------------------------------------------------------------------


def _list_in_few_tasks(spark: SparkSession) -> None:
    """Directories are listed by a few tasks a core instead of one task each, unless the session says how."""
    if spark.conf.get(_LISTING, None) is None:
        spark.conf.set(_LISTING, str(_LISTING_TASKS * spark.sparkContext.defaultParallelism))


def table_exists(spark: SparkSession, table: Table) -> bool:
    """Whether the table is known. One left in its directory by an earlier session is re-attached."""
    _list_in_few_tasks(spark)
    if spark.catalog.tableExists(table.name):
        return True
    if table.location is None:
        return False
    rows, swaps = _readable(spark, table.location), _readable(spark, _log(spark, table))
    if not rows and not swaps:
        return False
    _create(spark, table)
    if table.part and rows:
        spark.catalog.recoverPartitions(table.name)
    finish_swaps(spark, table)
    return True


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, table: Table) -> None:
    parts = "PARTITIONED BY ({})".format(", ".join(f"`{p}`" for p in table.parts)) if table.part else ""
    place = f"LOCATION {_quoted(table.location)}" if table.location else ""
    spark.sql(f"CREATE TABLE {table.name} ({table.types.toDDL()}) USING parquet {parts} {place}")


def ensure_table(spark: SparkSession, table: Table) -> bool:
    """Create the table if it is missing; says whether it was there before."""
    known = table_exists(spark, table)
    if not known:
        _create(spark, table)
    return known


def stored_rows(spark: SparkSession, table: Table) -> DataFrame:
    """All columns as stored, the partition columns included."""
    if not table_exists(spark, table):
        raise MissingTableError(f"table {table.name} does not exist yet")
    rows = spark.table(table.name)
    return _without_masked(spark, table, rows) if table.key and _readable(spark, _masks(spark, table)) else rows


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    """The table under its contract: declared columns in declared order."""
    return stored_rows(spark, table).select(*table.schema.names)


def read_or_empty(spark: SparkSession, table: Table) -> DataFrame:
    if table_exists(spark, table):
        return read_table(spark, table)
    return spark.createDataFrame([], table.schema)


# --- swaps -----------------------------------------------------------------------------------


def _root(spark: SparkSession, table: Table) -> str:
    if table.location:
        return table.location.rstrip("/")
    *database, name = table.name.split(".")
    owner = ".".join(database) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(owner).locationUri.rstrip('/')}/{name}"


def _log(spark: SparkSession, table: Table) -> str:
    return f"{_root(spark, table)}.swaps"


def _swap_name(spark: SparkSession, table: Table) -> str:
    """A name above those of all swaps the catalog knows, also when a clock is set back."""
    _, last = _applied(spark, table)
    return f"{max(now_micros(), int(last[:20] or 0) + 1):020d}-{uuid.uuid4().hex}"


def _swap(
    spark: SparkSession, table: Table, rows: DataFrame, parts: list[str] | None = None, swap: str | None = None
) -> None:
    """Replace every part that occurs in ``rows``, or the whole table if it has no parts. Stored ``parts``
    (by the names of their directories) that do not occur any more become empty. ``swap`` is the swap's
    name, if the caller has given it one."""
    done = finish_swaps(spark, table)
    swap = swap or _swap_name(spark, table)
    place = f"{_root(spark, table)}.versions/{swap}"
    (rows.write.partitionBy(*table.parts) if table.part else rows.write).parquet(place)
    places = _places(spark, table, place)
    # a folder that nothing was written to has no rows, and takes later ones
    places += [(part, f"{place}/{part}") for part in sorted(set(parts or ()) - {part for part, _ in places})]
    if places:
        _record(spark, table, swap, places)
        _apply(spark, table, places, swap, done + 1)


def _places(spark: SparkSession, table: Table, place: str) -> list[tuple[str, str]]:
    """Where each part of a finished write is, by the names of its directories. Files are listed,
    not read."""
    if not table.part:
        return [("", place)]
    depth, found = len(table.parts), set()
    for path in spark.read.schema(table.types).parquet(place).inputFiles():
        steps = unquote(path).rsplit("/", depth + 1)[1:-1]
        found.add(("/".join(steps), "/".join([place, *steps])))
    return sorted(found)


def _record(spark: SparkSession, table: Table, swap: str, places: list[tuple[str, str]]) -> None:
    """One file of the log, which is there whole or not at all."""
    rows = spark.createDataFrame([(swap, *place) for place in places], _SWAP)
    rows.coalesce(1).write.mode("append").parquet(_log(spark, table))


def finish_swaps(spark: SparkSession, table: Table) -> int:
    """Apply recorded swaps that the catalog does not have yet, in their order; may be repeated.
    Returns how many the log has. It is read only if it has more than the catalog knows of."""
    log = _log(spark, table)
    if not _readable(spark, log):
        return 0
    rows = spark.read.schema(_SWAP).parquet(log)
    files = len(rows.inputFiles())
    count, last = _applied(spark, table)
    if files > count:
        newest = F.max_by("place", "swap").alias("place")
        moved = rows.where(F.col("swap") > last).groupBy("part").agg(newest, F.max("swap").alias("swap"))
        found = moved.collect()
        if found:
            places = [(row["part"], row["place"]) for row in found]
            _apply(spark, table, places, max(row["swap"] for row in found), files)
    return files


def _applied(spark: SparkSession, table: Table) -> tuple[int, str]:
    """How many swaps the catalog knows, and the last one; locations and this mark are in one place."""
    shown = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table.name}").collect()}
    count, _, last = shown.get(_APPLIED, "0:").partition(":")
    return int(count), last


def _apply(spark: SparkSession, table: Table, places: list[tuple[str, str]], swap: str, count: int) -> None:
    """Point the catalog at the new files of parts, then note that it is done."""
    for part, place in places:
        _move(spark, table, part, place)
    spark.sql(f"ALTER TABLE {table.name} SET TBLPROPERTIES ('{_APPLIED}' = '{count}:{swap}')")
    spark.catalog.refreshTable(table.name)


def _move(spark: SparkSession, table: Table, part: str, place: str) -> None:
    """``part`` is a part's directory below the table's, empty for the whole table."""
    if not part:
        spark.sql(f"ALTER TABLE {table.name} SET LOCATION {_quoted(place)}")
        return
    values = [unquote(step.split("=", 1)[1]) for step in part.split("/")]
    spec = ", ".join(
        f"`{name}` = {'NULL' if value == _NO_VALUE else _quoted(value)}" for name, value in zip(table.parts, values)
    )
    spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_quoted(place)}")
    spark.sql(f"ALTER TABLE {table.name} PARTITION ({spec}) SET LOCATION {_quoted(place)}")


# --- buckets ---------------------------------------------------------------------------------


def part_sizes(rows: DataFrame, part: str) -> dict[str, int]:
    """The parts of a batch and their rows. A part is a day, a layer or a version: a short list."""
    return {row[0]: row[1] for row in rows.groupBy(part).agg(F.count("*")).collect()}


def _stored(spark: SparkSession, table: Table) -> list[tuple[str, tuple[str, ...]]]:
    """Parts the catalog knows: their directory's name and their values."""
    if not table.part:
        return []
    names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect()]
    return [(name, tuple(unquote(step.split("=", 1)[1]) for step in name.split("/"))) for name in names]


def stored_buckets(spark: SparkSession, table: Table) -> dict[str, list[str]]:
    """Parts the catalog knows with the folders of their buckets, without a look at the rows."""
    found: dict[str, list[str]] = {}
    for _, (part, *bucket) in _stored(spark, table):
        found.setdefault(part, []).extend(bucket)
    return found


def _first_layer(folder: str) -> str:
    """The name of a folder without its layer."""
    return folder.partition(_LAYER)[0] if _MORE in folder else folder


def _layer_of(folder: str) -> str:
    return folder.partition(_LAYER)[2] if _MORE in folder else ""


@dataclass(frozen=True)
class Shape:
    """How a part is divided: the digits of its buckets, the digits its folders have of them, and the
    layer that takes new rows."""

    digits: int = 0
    folder_digits: int = 0
    layer: str = ""

    @property
    def shared(self) -> bool:
        """Whether a folder holds several buckets."""
        return self.folder_digits < self.digits


def _stored_shape(folders: list[str]) -> Shape:
    if not folders or UNDIVIDED in folders:
        return Shape()
    own = [_first_layer(folder).rstrip(_MORE) for folder in folders]
    return Shape(len(_first_layer(folders[0])), len(own[0]), max(map(_layer_of, folders)))


def digits_for(rows: int, bucket_rows: int) -> int:
    """Leading digits that leave a bucket about ``bucket_rows`` rows at most."""
    digits = 0
    while digits < _MOST_DIGITS and rows > bucket_rows * 16**digits:
        digits += 1
    return digits


def folder_of(table: Table, shapes: dict[str, Shape], digits: Column | None = None, layer: str | None = None) -> Column:
    """The folder of a row, or of what begins with the same ``digits``, by the shape of its part; a part that
    is not named is undivided. Folders that buckets share are named with the part's layer or with this one."""
    digits = F.col(table.key) if digits is None else digits
    folder = F.lit(UNDIVIDED)
    for shape in sorted({shape for shape in shapes.values() if shape.digits}, key=str):
        parts = [part for part, own in shapes.items() if own == shape]
        name = F.substring(digits, 1, shape.folder_digits)
        if shape.shared:
            own_layer = shape.layer if layer is None else layer
            name = F.concat(F.rpad(name, shape.digits, _MORE), F.lit(_LAYER + own_layer if own_layer else ""))
        folder = F.when(F.col(table.part).isin(parts), name).otherwise(folder)
    return folder


def _shapes(spark: SparkSession, table: Table, sizes: dict[str, int]) -> dict[str, Shape]:
    """A stored part keeps its shape; a new one gets what its rows ask for."""
    known = stored_buckets(spark, table)
    shapes = {part: _stored_shape(known[part]) for part in sizes if part in known}
    new = {part: digits_for(size, table.bucket_rows) for part, size in sizes.items() if part not in known}
    few = sum(16**digits for digits in new.values()) <= _OWN_FOLDERS
    for part, digits in new.items():
        shapes[part] = Shape(digits, digits if few else min(digits, digits_for(sizes[part], _FOLDER_ROWS)))
    return shapes


def dealt(
    spark: SparkSession, table: Table, rows: DataFrame, sizes: dict[str, int] | None = None
) -> DataFrame:
    """Rows with the folder each belongs to. A stored part keeps its digits; a new one gets as many
    as its rows ask for. ``sizes`` are rows by part, if the caller knows them."""
    if not table.key:
        return rows
    sizes = part_sizes(rows, table.part) if sizes is None else sizes
    return rows.withColumn(KEY_BUCKET, folder_of(table, _shapes(spark, table, sizes)))


def by_bucket(table: Table, rows: DataFrame) -> DataFrame:
    """Stored or dealt rows with the bucket of each instead of its folder."""
    folder = F.col(KEY_BUCKET)
    digits = F.length(F.substring_index(folder, _LAYER, 1))
    bucket = F.when(folder.contains(_MORE), F.substring(F.col(table.key), F.lit(1), digits)).otherwise(folder)
    return rows.withColumn(KEY_BUCKET, bucket)


# --- masks -----------------------------------------------------------------------------------


def _masks(spark: SparkSession, table: Table) -> str:
    return f"{_root(spark, table)}.masks"


def _without_masked(spark: SparkSession, table: Table, rows: DataFrame) -> DataFrame:
    """Rows but those whose bucket was rewritten into a later layer. A layer and its masks count from when its
    swap is done, so a reader sees all of a swap or nothing."""
    _, last = _applied(spark, table)
    layers = {_layer_of(folder) for _, (_, folder) in _stored(spark, table)}
    layers = sorted(layer for layer in layers if "" < layer <= last)
    folder = F.col(KEY_BUCKET)
    layer = F.when(folder.contains(_MORE) & folder.contains(_LAYER), F.substring_index(folder, _LAYER, -1))
    layer = F.coalesce(layer, F.lit(""))
    named = StructType([StructField("_part", table.types[table.part].dataType), *_MASK.fields])
    # masks of a swap that was never recorded are no one's
    masks = spark.read.schema(named).parquet(_masks(spark, table)).where(F.col("_layer").isin(layers))
    newest = masks.groupBy("_part", "_bucket").agg(F.max("_layer").alias("_newest"))
    bucket = F.substring(F.col(table.key), F.lit(1), F.length(F.substring_index(folder, _LAYER, 1)))
    masked = (F.col(table.part) == F.col("_part")) & (bucket == F.col("_bucket")) & (layer < F.col("_newest"))
    return rows.where(layer.isin(["", *layers])).join(newest, masked, "left_anti")


def _replace_buckets(
    spark: SparkSession, table: Table, rows: DataFrame, buckets: DataFrame, hits: list, shapes: dict[str, Shape]
) -> str:
    """Replace the ``buckets`` of parts by ``rows``, both as ``by_bucket`` gives them; returns the swap's name.
    ``hits`` are the folders they are in. Where a folder is shared, rows go to a layer of it, and the buckets
    are masked in all earlier ones."""
    finish_swaps(spark, table)
    swap = _swap_name(spark, table)
    shared = [part for part, shape in shapes.items() if shape.shared]
    masks = buckets.where(F.col(table.part).isin(shared)).select(
        F.col(table.part).alias("_part"), F.col(KEY_BUCKET).alias("_bucket"), F.lit(swap).alias("_layer")
    )
    masks.distinct().write.mode("append").parquet(_masks(spark, table))
    keys = {tuple(hit[name] for name in table.parts) for hit in hits}
    names = set()
    for name, (part, folder) in _stored(spark, table):
        if (part, _first_layer(folder)) in keys:
            above, _, own = name.rpartition("/")
            names.add(f"{above}/{_first_layer(own)}{_LAYER}{swap}" if _MORE in folder else name)
    layered = rows.withColumn(KEY_BUCKET, folder_of(table, shapes, F.col(KEY_BUCKET), swap))
    _swap(spark, table, to_write(layered, table), sorted(names), swap)
    return swap


# --- writes ----------------------------------------------------------------------------------


def to_write(rows: DataFrame, table: Table, gather: bool = True) -> DataFrame:
    """Rows in stored order, and with ``gather`` collected by part and bucket first.

    Gathering shuffles the rows so that a task does not open a file in every part; adaptive
    execution splits a large part over several tasks and merges small ones. Rows read from files
    that hold one part each need no gathering and are written without a shuffle.
    """
    ordered = rows.select(*table.columns)
    return ordered.hint("rebalance", *table.parts) if gather and table.part else ordered


def append(
    spark: SparkSession,
    table: Table,
    rows: DataFrame,
    gather: bool = True,
    sizes: dict[str, int] | None = None,
) -> None:
    if ensure_table(spark, table):
        finish_swaps(spark, table)
    rows = dealt(spark, table, rows, sizes)
    to_write(rows, table, gather).write.insertInto(table.name)


def replace_parts(
    spark: SparkSession, table: Table, rows: DataFrame, parts: list[str] | None = None
) -> None:
    """Replace the parts that occur in ``rows``; the rows may come from the table itself. Of ``parts``
    those without a row become empty."""
    ensure_table(spark, table)
    stored = _stored(spark, table)
    wanted = [name for name, values in stored if values[0] in (parts or ())]
    if table.key and any(_MORE in values[1] for _, values in stored):
        _replace_shared(spark, table, rows, parts or [])
    else:
        _swap(spark, table, to_write(rows, table), wanted)


def _replace_shared(spark: SparkSession, table: Table, rows: DataFrame, parts: list[str]) -> None:
    """``replace_parts`` where folders are shared: of buckets, and then of what ``parts`` had before."""
    finish_swaps(spark, table)
    old = stored_rows(spark, table).where(F.col(table.part).isin(parts)).select(*table.parts)
    found = rows.select(*table.parts).unionByName(old).distinct().collect()
    folders: dict[str, list[str]] = {}
    found = [(part, folder) for part, folder in found if folder is not None]
    for part, folder in found:
        folders.setdefault(part, []).append(folder)
    shapes = {part: _stored_shape(own) for part, own in (folders | stored_buckets(spark, table)).items()}
    old = by_bucket(table, stored_rows(spark, table).where(F.col(table.part).isin(parts)))
    rows = by_bucket(table, rows)
    buckets = rows.select(*table.parts).unionByName(old.select(*table.parts)).distinct()
    hits = [{table.part: part, KEY_BUCKET: _first_layer(folder)} for part, folder in found]
    swap = _replace_buckets(spark, table, rows, buckets, hits, shapes)
    # nothing is read any more from earlier layers of these parts
    masked = [
        name
        for name, (part, folder) in _stored(spark, table)
        if part in parts and _MORE in folder and _layer_of(folder) != swap
    ]
    if masked:
        _swap(spark, table, to_write(stored_rows(spark, table).limit(0), table), masked)


def remove_rows(spark: SparkSession, table: Table, gone: DataFrame, parts: list[str]) -> int:
    """Take out rows of these parts that come from a file of ``gone`` (source_file, before) and were
    ingested before that instant; returns how many. Only buckets that hold one are rewritten."""
    if not parts or not table_exists(spark, table):
        return 0
    finish_swaps(spark, table)
    rows = stored_rows(spark, table).where(F.col(table.part).isin(parts))
    files = gone.select(F.col("source_file").alias("_file"), F.col("before").alias("_before"))
    stale = (F.col("source_file") == F.col("_file")) & (F.col("ingested_at") < F.col("_before"))
    shapes = _shapes(spark, table, dict.fromkeys(parts, 0)) if table.key else {}
    if any(shape.shared for shape in shapes.values()):
        gone = by_bucket(table, rows).join(files, stale, "left_semi")
        found = kept_once(gone.groupBy(*table.parts).agg(F.count("*").alias("rows")))
        hits = found.withColumn(KEY_BUCKET, folder_of(table, shapes, F.col(KEY_BUCKET), ""))
        hits = hits.groupBy(*table.parts).agg(F.sum("rows").alias("rows")).collect()
        if hits:
            buckets = found.select(*table.parts)
            left = by_bucket(table, rows.where(_in_buckets(table, hits, _FOLDER)))
            left = left.join(buckets, table.parts, "left_semi").join(files, stale, "left_anti")
            _replace_buckets(spark, table, left, buckets, hits, shapes)
        return sum(hit["rows"] for hit in hits)
    found = rows.join(files, stale, "left_semi").groupBy(*table.parts).agg(F.count("*").alias("rows"))
    hits = found.collect()
    if hits:
        keys = {tuple(hit[name] for name in table.parts) for hit in hits}
        names = [name for name, values in _stored(spark, table) if values in keys]
        left = rows.where(_in_buckets(table, hits)).join(files, stale, "left_anti")
        _swap(spark, table, to_write(left, table), names)
    return sum(hit["rows"] for hit in hits)


def overwrite(spark: SparkSession, table: Table, rows: DataFrame) -> None:
    """Replace a small snapshot table as a whole, written as one file."""
    ensure_table(spark, table)
    _swap(spark, table, rows.select(*table.columns).coalesce(1))


def kept_once(df: DataFrame) -> DataFrame:
    """Written below the session's checkpoint folder, so that it is worked out once; a session without
    one works it out at each use."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df


def upsert(
    spark: SparkSession,
    table: Table,
    source: DataFrame,
    key: str,
    parts: dict[str, int] | None = None,
    on_duplicate: str = "merge",
    gather: bool = True,
    replayed: list[str] | None = None,
) -> None:
    """Matching keys take the source's row, other source rows are added, nothing is deleted.

    ``source`` must give the same rows each time it is read. ``parts`` are its rows by part, if
    the caller knows them. ``on_duplicate="merge"`` stops only where several source rows hit one
    target row, and adds repeated new keys as they are; ``"reject"`` stops at any repeated key;
    ``"keep_last"`` takes the last row of a key. ``replayed`` names columns that tell rows of an
    earlier attempt: where repeated keys hit stored rows, source rows stored with equal values
    of the key and these columns are done and left out, so a write that was lost before its job
    finished can be run again.
    ``gather=False`` appends without a shuffle (see ``to_write``).

    The keys that match are looked for once and kept. They say which buckets are rewritten; a bucket
    without one is only appended to.
    """
    if on_duplicate not in ("merge", "reject", "keep_last"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    if on_duplicate == "reject" and not duplicate_keys(source, key).isEmpty():
        raise DuplicateKeyError(f"source of {table.name} repeats values of {key}")
    if on_duplicate == "keep_last":
        source = keep_last(source.select(*[c for c in table.columns if c != KEY_BUCKET]), key)
    part = table.part
    if not ensure_table(spark, table):
        append(spark, table, source, gather, parts)
        return
    finish_swaps(spark, table)
    parts = part_sizes(source, part) if parts is None else parts
    # days the table does not have can hold no match: their rows are never probed
    known = sorted(set(stored_buckets(spark, table)).intersection(parts))
    if not known:
        append(spark, table, source, gather, parts)
        return

    shapes = _shapes(spark, table, parts) if table.key else {}
    source = source.withColumn(KEY_BUCKET, folder_of(table, shapes)) if table.key else source
    stored = in_batch = stored_rows(spark, table).where(F.col(part).isin(known))
    shared = any(shapes[name].shared for name in known if name in shapes)
    if shared:
        source, in_batch = by_bucket(table, source), by_bucket(table, in_batch)
    if sum(parts[name] for name in known) > _SENT_ROWS:
        source = source.hint("merge")
    folder = folder_of(table, shapes, F.col(KEY_BUCKET), "") if shared else None
    matched, hits = _matches(in_batch, source.where(F.col(part).isin(known)), key, table.parts, folder)
    if replayed and any(hit["most_copies"] > 1 for hit in hits):
        # equal keys share a part, so only rows of known parts can be stored already
        source = without_stored(source, in_batch, [part, key, *replayed])
        matched, hits = _matches(in_batch, source.where(F.col(part).isin(known)), key, table.parts, folder)
    if any(hit["most_copies"] > 1 for hit in hits):
        raise DuplicateKeyError(f"several source rows share one stored {key} of {table.name}")

    keys = list(dict.fromkeys([*table.parts, key]))
    if shared:
        outside = source
        if hits:
            buckets = matched.select(*table.parts).distinct()
            target = by_bucket(table, stored.where(_in_buckets(table, hits, _FOLDER)))
            merged = merge_rows(
                target.join(buckets, table.parts, "left_semi"),
                source.join(buckets, table.parts, "left_semi"),
                keys,
                matched,
            )
            _replace_buckets(spark, table, merged, buckets, hits, shapes)
            outside = source.join(buckets, table.parts, "left_anti")
        outside = outside.withColumn(KEY_BUCKET, folder_of(table, shapes, F.col(KEY_BUCKET)))
        to_write(outside, table, gather).write.insertInto(table.name)
        return
    if not hits:
        to_write(source, table, gather).write.insertInto(table.name)
        return
    inside = _in_buckets(table, hits)
    merged = merge_rows(in_batch.where(inside), source.where(inside), keys, matched)
    _swap(spark, table, to_write(merged, table))
    if table.key or set(parts) - {hit[part] for hit in hits}:
        to_write(source.where(~inside), table, gather).write.insertInto(table.name)


def _matches(
    target: DataFrame, source: DataFrame, key: str, parts: list[str], folder: Column | None = None
) -> tuple[DataFrame, list]:
    """The matching keys, kept, and for each part or bucket with any, or for each ``folder`` of buckets: target
    rows hit, most source rows on one key."""
    matched = kept_once(matched_keys(target, source, key, parts))
    found = matched if folder is None else matched.withColumn(KEY_BUCKET, folder)
    return matched, matched_parts(target, source, key, parts, found).collect()


def _in_buckets(table: Table, hits: list, bucket: str = KEY_BUCKET) -> Column:
    """Rows of the parts, and buckets of them, that have a hit; reaches partition pruning."""
    if not table.key:
        return F.col(table.part).isin([hit[table.part] for hit in hits])
    by_buckets: dict[tuple[str, ...], list[str]] = {}
    found: dict[str, list[str]] = {}
    for hit in hits:
        found.setdefault(hit[table.part], []).append(hit[KEY_BUCKET])
    for part, buckets in found.items():
        by_buckets.setdefault(tuple(sorted(buckets)), []).append(part)
    inside = F.lit(False)
    for buckets, own in by_buckets.items():
        inside = inside | (F.col(table.part).isin(own) & F.expr(bucket).isin(list(buckets)))
    return inside


# --- compaction ------------------------------------------------------------------------------


def part_files(spark: SparkSession, table: Table) -> DataFrame:
    """(part, files, rows, file_bytes) of every part, from what a scan knows of its files."""
    rows = stored_rows(spark, table).select(
        table.part, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    )
    files = rows.groupBy(table.part, "file").agg(F.count("*").alias("rows"), F.max("size").alias("size"))
    return files.groupBy(table.part).agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("size").alias("file_bytes")
    )


def compact(spark: SparkSession, table: Table, file_bytes: int, most_files: int) -> list[str]:
    """Rewrite the parts that have more than ``most_files`` files to a bucket and more than their size
    in files of ``file_bytes`` asks for; returns them. Rows and buckets stay as they are."""
    if not table_exists(spark, table):
        return []
    finish_swaps(spark, table)
    buckets = stored_buckets(spark, table)
    many = [
        row[table.part]
        for row in part_files(spark, table).collect()
        if row["files"]
        > most_files * max(1, len(set(map(_first_layer, buckets[row[table.part]])))) + row["file_bytes"] // file_bytes
    ]
    if many:
        replace_parts(spark, table, stored_rows(spark, table).where(F.col(table.part).isin(many)))
    return sorted(many)
