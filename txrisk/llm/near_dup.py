"""Near-duplicate documents: fast similarity sketching, banding and exact verification.

A sketch has COORDINATES bins. In round i every shingle falls into a bin by its i-th hash and the
least (round, hash) of a bin stays; from round COORDINATES on, round i puts every shingle into bin
i - COORDINATES, so after at most 2 * COORDINATES rounds no bin is empty. Rounds end when all bins
are filled. Two sets agree in a bin with the probability of their Jaccard similarity, and the bins
are as concentrated as independent ones. Bins form bands; equal bands propose pairs, and a pair is
linked only if the whole shingle sets confirm it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .shared import stored
from .words import U64, mix, shingle_sets, text_chunks

#: 32 bands of 4 bins: a pair at similarity 0.8 shares no band with probability 5e-8.
COORDINATES = 128
BAND_ROWS = 4


def sketch_sets(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One sketch of t bins for each non-empty set of 64-bit hashes; t is a power of two."""
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    empty = np.iinfo(np.uint64).max
    bins = np.full((len(sets), t), empty, dtype=np.uint64)
    flat = bins.reshape(-1)
    shift = U64(64 - (t.bit_length() - 1))
    for i in range(2 * t):
        h = mix(values + U64((i + 1) * 0xD1B54A32D192ED03 & (2**64 - 1)))
        place = (h >> shift).astype(np.int64) if i < t else np.full(len(h), i - t)
        # the round, then bits of the hash that did not choose the bin
        np.minimum.at(flat, owner * t + place, (U64(i) << U64(48)) | (h & U64(2**48 - 1)))
        open_ = (bins == empty).any(axis=1)
        if not open_.any():
            break
        left = open_[owner]
        values, owner = values[left], owner[left]
        if not len(values):
            break
    return bins


def band_keys(bins: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit key for each band, different for different bands."""
    bands = bins.reshape(len(bins), bins.shape[1] // rows, rows)
    keys = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2])
    for j in range(rows):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + bands[:, :, j])
    return keys.astype(np.int64)


_SKETCH = "doc_id bigint, n_shingles bigint, same_set binary, bands array<bigint>"


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column(1)):
                sets = shingle_sets(texts, k)
                full = np.array([len(s) > 0 for s in sets], dtype=bool)
                bands = band_keys(sketch_sets([s for s in sets if len(s)]))
                ends = np.concatenate([[0], np.cumsum(full * bands.shape[1])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, texts.count),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(
                            [hashlib.md5(s).digest() if len(s) else None for s in sets], pa.binary()
                        ),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.reshape(-1))),
                    ],
                    ["doc_id", "n_shingles", "same_set", "bands"],
                )

    return run


def _set_maker(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(texts, k)]
                ids = batch.column(0).slice(texts.first, texts.count)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], ["id", "items"])

    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            items = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in part.column(1)]
            ids = np.repeat(np.asarray(part.column(0)), [len(x) for x in items])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.concatenate(items))], ["id", "item"]
            )


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            found = batch.filter(pa.array(keep, pa.bool_()))
            yield found.select(["a", "b"])

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    Sets are distinct k-word shingles of the whole text, A-Z lowered; a text with fewer words is one
    shingle; a text without words (null and empty too) has an empty set and links with nothing.
    Documents link if 100 * |intersection| >= percent * |union|. component_id is the smallest doc_id
    reachable; kept is true for that document. A row with a null doc_id links with nothing, its
    component_id is null and it is kept. Rows that repeat a doc_id count as one document, judged on
    the text of any of them when their texts differ; other columns of docs are not read.

    Scale: documents with equal sets become one class before banding, so a group of copies is one
    entry however large it is. In a band's bucket every class is first paired with the bucket's
    least class only. Classes already connected need no further pair. Buckets that still hold several
    components are settled by prefixes: sets in a common order, rarest shingles first, can only
    reach the similarity if they share one of their leading shingles, which is exact and leaves out
    sets with many shingles of their own. No candidate is dropped. What is left to pair are sets of
    different components with a leading shingle in common that fit by size and place: for documents
    made from one short template these are a share of all pairs (see README).
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketches = stored(rows.mapInArrow(_sketcher(k), _SKETCH), "sketches")
    known = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        known.groupBy("same_set").agg(
            F.min("doc_id").alias("id"),
            F.max("n_shingles").alias("size"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    entries = classes.select("id", "size", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
    buckets = buckets.where("n > 1").select("band", "hub")
    members = stored(entries.join(buckets, "band").select("band", "hub", "id", "size"), "members")
    texts = rows.where("doc_id IS NOT NULL")

    sizes = members.where("hub = id").select("band", F.col("size").alias("hub_size"))
    spokes = members.where("hub <> id").join(sizes, "band")
    spokes = spokes.where(_may_link("size", "hub_size", percent))
    spokes = spokes.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sets = stored(
        texts.join(
            stored(members.select(F.col("id").alias("doc_id")).distinct(), "linkable"), "doc_id"
        )
        .dropDuplicates(["doc_id"])
        .mapInArrow(_set_maker(k), "id bigint, items binary"),
        "sets",
    )
    links = stored(_verified(spokes, sets, percent), "confirmed")
    joined = components(links)

    placed = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "id", "size", F.coalesce("component", "id").alias("component")
    )
    open_ = _mixed(placed, "band").select("id", "size", "component").distinct()
    prefixes = _prefixes(stored(open_, "open"), sets, percent)
    rest = stored(_cross_pairs(prefixes, percent), "pairs")
    more = stored(_verified(rest, sets, percent), "confirmed")
    joined = components(links.union(more)) if more.head(1) else joined

    of_class = classes.select("same_set", "id").join(
        joined.withColumnRenamed("node", "id"), "id", "left"
    )
    of_class = of_class.select("same_set", F.coalesce("component", "id").alias("component_id"))
    found = sketches.select("doc_id", "n_shingles", "same_set").join(of_class, "same_set", "left")
    # a null id took no part in the classes: it keeps no component of a text it happens to share
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


#: Names of rows that cannot go by their doc_id begin here; a real doc_id is taken to be lower.
_SURROGATES = 1 << 62


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns as they are, but only one of each group of near copies.

    Of a group the row with the smallest doc_id stays. Rows without a doc_id, and all but one of the rows
    that share one, are documents by themselves and come after all others: copies among them go
    like any copy, and different texts under one doc_id are each judged on their own. Rows without
    words (null and empty texts too) are copies of nothing and stay. An empty table gives no rows.

    Only where a doc_id is missing or repeated are the rows numbered, in a stored copy, so that a row
    keeps its number whatever is run again.
    """
    name = "_row_name"
    repeated = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if repeated.isEmpty():
        named = docs.withColumn(name, F.col("doc_id").cast("bigint"))
    else:
        named = _named(docs, name)
    judged = near_duplicates(named.select(F.col(name).alias("doc_id"), "text"), k, percent)
    gone = judged.where("NOT kept").select(F.col("doc_id").alias(name))
    return named.join(gone, name, "left_anti").select(*docs.columns)


def _named(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a name each: the doc_id of the first row that has it, numbers above all ids else."""
    number = "_row_number"
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    first = rows.groupBy(F.col("doc_id").alias("_again")).agg(F.min(number).alias("_first"))
    own = F.col("doc_id").isNotNull() & (F.col("_first") == F.col(number))
    return rows.join(first, F.col("doc_id").eqNullSafe(F.col("_again")), "left").withColumn(
        name, F.when(own, F.col("doc_id").cast("bigint")).otherwise(F.lit(_SURROGATES) + F.col(number))
    )


def _may_link(x: str, y: str, percent: int):
    """Sets whose sizes differ by more cannot reach the similarity."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """The rows of those keys that meet more than one component."""
    mixed = rows.groupBy(key).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(mixed.where("low <> high").select(key), key)


def _prefixes(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, size, component, item, place): the leading items of the sets of open_ (id, size,
    component), when all sets are put in one order, rarest items first. Two sets can only reach the
    similarity if they share one of these. Items of one set alone come first and are only counted.
    """
    items = sets.join(open_.select("id"), "id", "left_semi").mapInArrow(_explode, "id bigint, item bigint")
    items = stored(items, "items")
    shared = items.groupBy("item").agg(F.count("*").alias("n")).where("n > 1")
    common = items.join(shared, "item").join(open_, "id")
    rare_first = Window.partitionBy("id").orderBy("n", "item")
    ranked = common.withColumns(
        {
            "nth": F.row_number().over(rare_first),
            "own": F.col("size") - F.count("*").over(Window.partitionBy("id")),
        }
    )
    place = F.col("own") + F.col("nth")
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    return ranked.where(place <= length).select(
        "id", "size", "component", "item", place.alias("place")
    )


def _cross_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different components that share a leading item and can reach the similarity
    by their sizes and by what is left of both sets from that item on. An item's largest component
    is not paired with itself, nor is any other."""
    open_ = stored(_mixed(prefixes, "item"), "prefixes")
    sizes = open_.groupBy("item", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("item").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    strays = open_.join(main, "item").where("component <> main")
    others = open_.select("item", *[F.col(c).alias(f"{c}_2") for c in ("id", "size", "component", "place")])
    left = 1 + F.least(F.col("size") - F.col("place"), F.col("size_2") - F.col("place_2"))
    enough = (100 + percent) * left >= percent * (F.col("size") + F.col("size_2"))
    pairs = strays.join(others, "item").where(
        (F.col("component") != F.col("component_2")) & _may_link("size", "size_2", percent) & enough
    )
    return pairs.select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "items_a", "items_b")
    return both.mapInArrow(_verifier(percent), "a bigint, b bigint")
