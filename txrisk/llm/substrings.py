"""Repeated substrings of at least LENGTH bytes, by range-partitioned sparse suffix arrays.

Every LENGTH-byte string has an anchor, the leftmost least hash of its GRAM-byte substrings, so equal
strings have equal anchors at equal places. Consecutive strings with one anchor form a run. First
the hashes of all anchors are counted; an anchor whose GRAM bytes occur once in the corpus holds no
repetition. The runs of the others are suffixes of the corpus, cut off behind their last string.
They are put in order: sampled splitters on leading bytes range-partition them, a bucket is sorted
by multikey quicksort over eight-byte tokens, and equal neighbours are found, also across the
boundaries of buckets. All but the earliest of equal runs are repetitions in full. Earliest runs that share
only a core with other runs are cut into shorter ones, down to single strings, and sorted again.

Texts are never shuffled: passes over the table read what was found for their own part of it. Parts
are the partitions of the scan, and a part that is not what it was in the first pass is an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_folder, stored
from .words import _BASE, _CODES, U64, Texts, mix, text_chunks

LENGTH = 100
GRAM = 40
#: Strings of a run are cut into blocks of so many, by their distance from the anchor.
BLOCKS = (LENGTH, 16, 4, 1)
#: Bytes of suffixes that a task sorts.
BUCKET_BYTES = 12 << 20
#: Whole texts are looked at in chunks of about so many bytes.
CHUNK = 1 << 19
#: A longer text is looked at in pieces of so many strings.
PIECE = 1 << 22
_PLACE_BITS = 23
_NO_ID = 2**63 - 1


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive bytes, by doubling."""
    part, done, out, size = _CODES[data], 0, None, 1
    while True:
        if k & size:
            if out is None:
                out = part
            else:
                n = len(data) - done - size + 1
                out = out[:n] + part[done : done + n] * U64(pow(_BASE, done, 1 << 64))
            done += size
        if done == k:
            return mix(out)
        n = len(part) - size
        part = part[:n] + part[size:] * U64(pow(_BASE, size, 1 << 64))
        size *= 2


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(texts: Texts) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, anchor, anchor's hash) of all runs of a chunk, in order;
    positions are in the chunk."""
    found = []
    size = len(texts.data)
    for begin in range(0, max(size - LENGTH + 1, 0), PIECE):
        data = texts.data[begin : begin + PIECE + LENGTH - 1]
        hashes = gram_hashes(data, GRAM)
        places = np.arange(len(hashes), dtype=np.uint64)
        keyed = (hashes >> U64(_PLACE_BITS) << U64(_PLACE_BITS)) | places
        least = _window_min(keyed, LENGTH - GRAM + 1)
        new = np.ones(len(least), dtype=bool)
        new[1:] = least[1:] != least[:-1]
        edges = texts.bounds[(texts.bounds >= begin) & (texts.bounds < begin + len(least))] - begin
        new[edges] = True
        at = np.flatnonzero(new)
        text = np.searchsorted(texts.bounds, at + begin, side="right") - 1
        # a run ends before the next one, and with the last whole string of its text
        last = np.append(at[1:], len(least)) - 1 + begin
        last = np.minimum(last, texts.bounds[text + 1] - LENGTH)
        whole = last >= at + begin
        at, text, last = at[whole], text[whole], last[whole]
        anchor = (least[at] & U64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        found.append((text, at + begin, last, anchor + begin, hashes[anchor]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(column) for column in zip(*found))


class _Part:
    """The partition a task reads, with a checksum to know it again."""

    def __init__(self) -> None:
        self.number = TaskContext.get().partitionId()
        self.rows, self.sum = 0, 0

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, Texts]]:
        """doc_id (null: the largest), number of the first row, and the texts of each chunk."""
        for batch in batches:
            ids = np.asarray(pc.fill_null(batch.column(0), _NO_ID))
            for texts in text_chunks(batch.column(1), CHUNK):
                own = ids[texts.first : texts.first + texts.count]
                self.sum = zlib.crc32(texts.bounds.tobytes(), zlib.crc32(own.tobytes(), self.sum))
                yield own, self.rows, texts
                self.rows += texts.count

    def mark(self) -> tuple[int, int]:
        return self.rows, self.sum


def _hash_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different anchors of a part, how often each occurs in it, and the part's mark in a row without
    a hash."""
    part, hashes = _Part(), [np.zeros(0, np.uint64)]
    for _, _, texts in part.chunks(batches):
        hashes.append(runs(texts)[4])
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    names = ["hash", "part", "n", "n_rows", "mark"]
    for first in range(0, len(values), 100_000):
        v = values[first : first + 100_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(v.view(np.int64)),
                pa.array(np.full(len(v), part.number, np.int32)),
                pa.array(counts[first : first + 100_000]),
                pa.nulls(len(v), pa.int64()),
                pa.nulls(len(v), pa.int64()),
            ],
            names,
        )
    rows, mark = part.mark()
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), pa.array([part.number], pa.int32()), pa.array([1])]
        + [pa.array([rows], pa.int64()), pa.array([mark], pa.int64())],
        names,
    )


def _by_part(df: DataFrame, name: str) -> str:
    """Writes df in a folder for each part; the path."""
    path = new_folder(df.sparkSession, name)
    df.repartition("part").write.partitionBy("part").parquet(path)
    return path


def _of_part(path: str, part: int, columns: list[str]) -> pa.Table | None:
    """These columns of what was written for a part, or None."""
    system, name = fs.FileSystem.from_uri(f"{path}/part={part}")
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return None
    return ds.dataset(name, filesystem=system, format="parquet").to_table(columns)


_ANCHOR = ["hash", "n_rows", "mark"]
_RUN = "doc bigint, part int, row int, start int, reach int, core bigint, text binary"
_NAMES = [x.split()[0] for x in _RUN.split(", ")]
#: Enough to find a run in its part again.
_OPEN = ["row", "start", "size", "reach"]


def _repeated_runs(anchors: str):
    """Runs whose anchor occurs elsewhere. Of a run from start, reach is the anchor's distance, and
    core a hash of the bytes that all strings of its block have in common, and of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part()
        known = _of_part(anchors, part.number, _ANCHOR)
        hashes = np.zeros(0, np.uint64)
        if known is not None:
            hashes = np.sort(known.column("hash").drop_null().to_numpy().astype(np.int64).view(np.uint64))
        for ids, first_row, texts in part.chunks(batches):
            text, first, last, anchor, value = runs(texts)
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            keep = hashes[at] == value
            text, first, last = text[keep], first[keep], last[keep]
            anchor, value = anchor[keep], value[keep]
            data = texts.data.tobytes()
            for i in range(0, len(text), 20_000):
                s = slice(i, i + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[text[s]]),
                        pa.array(np.full(len(text[s]), part.number, np.int32)),
                        pa.array((first_row + text[s]).astype(np.int32)),
                        pa.array((first[s] - texts.bounds[text[s]]).astype(np.int32)),
                        pa.array((anchor[s] - first[s]).astype(np.int32)),
                        pa.array(value[s].view(np.int64)),
                        pa.array([data[a : b + LENGTH] for a, b in zip(first[s], last[s])], pa.binary()),
                    ],
                    _NAMES,
                )
        _same(part, known)

    return run


def _same(part: _Part, known: pa.Table | None) -> None:
    marks = [] if known is None else known.filter(pc.is_valid(known.column("n_rows"))).to_pylist()
    if part.rows and [(m["n_rows"], m["mark"]) for m in marks] != [part.mark()]:
        raise ValueError("the table was read in other parts than before; store it first")


def multikey_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the texts in sorted order, equal texts in their given order, and the dense rank of
    each place. Texts are sorted by their first eight bytes, then what is equal by the next eight,
    and so on; a text that ends goes before one that goes on."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    width = -(-int(lengths.max(initial=0)) // 8)
    tokens = np.frombuffer(b"".join([t.ljust(8 * width, b"\0") for t in texts]), dtype=">u8")
    tokens = tokens.reshape(len(texts), width)
    order = np.arange(len(texts))
    group = np.zeros(len(texts), dtype=np.int64)  # where the place's group of equals begins
    todo = order.copy()  # places in groups of several
    for column in [*range(width), None]:
        if not len(todo):
            break
        rows = order[todo]
        # at the end texts differ in length only, by trailing zero bytes
        values = lengths[rows] if column is None else tokens[rows, column].astype(np.uint64)
        by = np.lexsort((values, group[todo]))
        order[todo], values = rows[by], values[by]
        new = np.ones(len(todo), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (group[todo][1:] != group[todo][:-1])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(todo)))
        group[todo] = np.repeat(todo[begins], sizes)
        todo = todo[np.repeat(sizes, sizes) > 1]
    return order, group


_SORTED = (
    "bucket int, head boolean, repeated boolean, doc bigint, part int, row int, start int, "
    "size int, reach int, core bigint, low binary, high binary"
)


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket in order, without the texts: rows equal to the one before are repeated. The first
    row (head) has the bucket's first and last text, for the comparison across boundaries."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    table = table.combine_chunks()
    keys = [np.asarray(table.column(c)) for c in ("doc", "part", "row", "start")]
    table = table.take(pa.array(np.lexsort(keys[::-1])))
    texts = table.column("text").to_pylist()
    order, group = multikey_order(texts)
    repeated = group != np.arange(len(order))
    table = table.take(pa.array(order))
    n = table.num_rows
    head = np.arange(n) == 0
    edge = lambda t: pa.array([t] + [None] * (n - 1), pa.binary())
    out = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)),
            pa.array(head),
            pa.array(repeated),
            *(table.column(c).combine_chunks() for c in ("doc", "part", "row", "start")),
            pa.array(np.array([len(texts[i]) for i in order], np.int32)),
            *(table.column(c).combine_chunks() for c in ("reach", "core")),
            edge(texts[order[0]]),
            edge(texts[order[-1]]),
        ],
        [x.split()[0] for x in _SORTED.split(", ")],
    )
    for first in range(0, n, 50_000):
        yield out.slice(first, 50_000)


def sort_suffixes(suffixes: DataFrame, total_bytes: int, name: str) -> DataFrame:
    """The suffixes in buckets by range, sorted, each known as repeated or as the earliest."""
    keys = ["text", "doc", "part", "row", "start"]
    buckets = max(1, -(-total_bytes // BUCKET_BYTES))
    ranged = suffixes.repartitionByRange(buckets, *keys)
    found = stored(ranged.mapInArrow(_sort_bucket, _SORTED), name)
    # one row a bucket: is its first text the last one of the bucket before?
    edges = sorted(found.where("head").select("bucket", "low", "high").collect())
    joined = [b[0] for a, b in zip(edges, edges[1:]) if bytes(a[2]) == bytes(b[1])]
    crossing = F.col("head") & F.col("bucket").isin(joined) if joined else F.lit(False)
    return found.withColumn("repeated", F.col("repeated") | crossing).drop("low", "high")


def _cut(anchors: str, open_: str, block: int):
    """Runs found open in a part, read from its own texts and cut at distances from the anchor that are
    multiples of block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part()
        table = _of_part(open_, part.number, _OPEN)
        runs_ = np.zeros((len(_OPEN), 0), np.int64)
        if table is not None:
            runs_ = np.stack([table.column(c).to_numpy().astype(np.int64) for c in _OPEN])
            runs_ = runs_[:, np.lexsort((runs_[1], runs_[0]))]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for ids, first_row, texts in part.chunks(batches):
            a, b = np.searchsorted(runs_[0], [first_row, first_row + texts.count])
            data = texts.data.tobytes() if a < b else b""
            for i in range(a, b, 10_000):
                rows = []
                for row, start, size, reach in runs_[:, i : min(i + 10_000, b)].T.tolist():
                    doc, begin = int(ids[row - first_row]), int(texts.bounds[row - first_row]) + start
                    text = data[begin : begin + size]
                    least = reach - (size - LENGTH)  # the nearest string's distance
                    far = reach
                    while far >= least:
                        near = max(far // block * block, least)
                        at = reach - far
                        piece = text[at : at + (far - near) + LENGTH]
                        base = far // block * block
                        core = text[reach - base : reach - base - block + 1 + LENGTH]
                        digest = hashlib.blake2b(core, digest_size=8, salt=base.to_bytes(8)).digest()
                        core_hash = int.from_bytes(digest, signed=True)
                        rows.append((doc, part.number, row, start + at, far, core_hash, piece))
                        far = near - 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)
        _same(part, _of_part(anchors, part.number, _ANCHOR))

    return run


def _remover(anchors: str, found: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part()
        table = _of_part(found, part.number, ["row", "start", "end"])
        rows = np.zeros((3, 0), np.int64)
        if table is not None:
            rows = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "end")])
            rows = rows[:, np.lexsort((rows[1], rows[0]))]
        for ids, first_row, texts in part.chunks(batches):
            a, b = np.searchsorted(rows[0], [first_row, first_row + texts.count])
            text = rows[0, a:b] - first_row
            marks = np.zeros(len(texts.data) + 1, dtype=np.int32)
            np.add.at(marks, rows[1, a:b] + texts.bounds[text], 1)
            np.add.at(marks, rows[2, a:b] + texts.bounds[text], -1)
            gone = np.cumsum(marks)[:-1] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            # a removed run that begins with its text, right behind one that ends the text before
            edges = texts.bounds[:-1][texts.bounds[:-1] < len(gone)]
            begins[edges] = gone[edges]
            sums = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(begins)])
            low, high = texts.bounds[:-1], texts.bounds[1:]
            kept = [texts.data[x:y][~gone[x:y]].tobytes() for x, y in zip(low, high)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == _NO_ID),
                    pa.array(high - low),
                    pa.array(sums[high] - sums[low]),
                    pa.array(spans[high] - spans[low]),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )
        _same(part, _of_part(anchors, part.number, _ANCHOR))

    return run


def without_repeats(docs: DataFrame, copy: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row of docs (doc_id, text): kept is the
    UTF-8 bytes of the text without every byte that a LENGTH-byte string covers which also starts
    earlier, in a smaller doc_id or before in the same text. n_spans counts maximal removed runs.

    A null text counts as empty; a null doc_id comes after all others. Rows that repeat a doc_id
    follow one another as they lie in the table, so of repeated rows one keeps its bytes. Matches
    never cross rows. Other columns are not read. Texts of under LENGTH bytes are kept.

    copy: store the texts first. Only a plain table that Spark reads in the same parts every time
    does without; parts that differ raise an error.

    Scale: a part sends its different anchor hashes once, about one for 30 bytes; a hash of every
    document costs one row a part. Sorting moves the runs of repeated anchors. A suffix that a third
    of all rows share spans as many buckets as it fills.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(rows, "texts") if copy else rows
    seen = rows.mapInArrow(
        _hash_anchors, "hash bigint, part int, n bigint, n_rows bigint, mark bigint"
    )
    # the mark's row has no hash: its part and number make a group of their own
    grouped = seen.groupBy("hash", F.when(F.col("hash").isNull(), F.col("part")).alias("of")).agg(
        F.collect_list("part").alias("parts"),
        F.sum("n").alias("n"),
        F.max("n_rows").alias("n_rows"),
        F.max("mark").alias("mark"),
    )
    grouped = grouped.where("hash IS NULL OR n > 1")
    spread = grouped.select("hash", "n", "n_rows", "mark", F.posexplode("parts").alias("nth", "part"))
    # occurrences in all parts, in the row of one part only
    once = F.when(F.col("hash").isNotNull() & (F.col("nth") == 0), F.col("n")).alias("n")
    anchors = _by_part(spread.select(*_ANCHOR, once, "part"), "anchors")
    # not stored: the range partitioning's sample reads the texts once more, which costs less disk
    # texts of runs that are cut are read from the part again, so what is found is kept without them
    suffixes = rows.mapInArrow(_repeated_runs(anchors), _RUN)
    # every occurrence is a run, copies in one part too; no run is longer than that
    occurrences = rows.sparkSession.read.parquet(anchors).agg(F.sum("n")).first()[0] or 0
    total = occurrences * (2 * LENGTH - GRAM)
    found, removed = sort_suffixes(suffixes, total, "suffixes"), None
    for block in BLOCKS[1:]:
        gone = _intervals(found)
        removed = gone if removed is None else removed.unionByName(gone)
        firsts = found.where("NOT repeated").select("core", "part", *_OPEN)
        shared = firsts.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
        open_ = firsts.join(shared.select("core"), "core", "left_semi").drop("core")
        pieces = stored(rows.mapInArrow(_cut(anchors, _by_part(open_, "open"), block), _RUN), "pieces")
        total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        found = sort_suffixes(pieces, total, "suffixes")
    removed = removed.unionByName(_intervals(found))
    return rows.mapInArrow(
        _remover(anchors, _by_part(removed, "repeats")),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary",
    )


def _intervals(found: DataFrame) -> DataFrame:
    end = (F.col("start") + F.col("size")).alias("end")
    return found.where("repeated").select("part", "row", "start", end)


def digest(kept: DataFrame) -> DataFrame:
    """The rows of without_repeats() with the SHA-256 of the kept bytes in their place."""
    sha = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", sha)
