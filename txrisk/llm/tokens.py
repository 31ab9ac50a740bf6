"""Token ids of whole documents as Parquet list columns, in ascending doc_id order.

Files hold one row a document: its ids, their number and where it starts in its file. Spark's
Parquet writer dictionary-encodes the ids and delta-encodes the metadata, with row groups and pages
of a set size and page indexes, so a reader takes the metadata, or the ids of some documents, without
reading the rest.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import new_folder
from .words import Texts, range_hashes, text_chunks

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
FILE_BYTES = 64 << 20
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 1000
#: Pieces of words whose ids a Python worker remembers; beyond it forgets rare ones and goes on.
REMEMBERED = 1_500_000
#: Text that is cut into pieces at once.
PIECE_BYTES = 1 << 20

#: The vocabulary's rules as this module follows them: what the file must say for its pieces to be cut here.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_WORD_END = "</w>"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# classes of bytes: white space, letters, digits, other printable ASCII, and what only the library judges
_SPACE, _LETTER, _DIGIT, _OTHER, _HARD = range(5)
_CLASS = np.full(256, _HARD, dtype=np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[[0x20, 0x09, 0x0A, 0x0D]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = re.compile(rb"[ \t\n\r][^ \t\n\r]*\Z")


def _after(places: np.ndarray, by: int, size: int) -> np.ndarray:
    return places[places < size - by] + by


class Pieces:
    """Pieces of a chunk of texts as byte ranges, found by array operations on its bytes.

    The vocabulary's rules drop white space and never look across it, lower letters, and split words
    into letters, digits and the rest. So words of ASCII and Latin-1 letters are cut here; any other
    word is one piece, as it is, for the library.
    """

    def __init__(self, texts: Texts) -> None:
        data, size = texts.data, len(texts.data)
        kind = _CLASS[data]
        self.low = _LOWER[data]
        first = np.zeros(size + 1, dtype=bool)
        first[texts.bounds[:-1]] = True
        first = first[:size]
        hard = bool((kind == _HARD).any())
        if hard:
            # letters of Latin-1 are two bytes, 0xC3 and one of 0x80 to 0xBF but for the signs x and :
            lead = np.flatnonzero(data[:-1] == 0xC3)
            tail = data[lead + 1]
            lead = lead[(tail != 0x97) & (tail != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
            capital = lead[data[lead + 1] < 0x9F] + 1
            self.low[capital] += 32
        # a special token of the vocabulary begins so
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C) & ~first[1:])
        kind[special] = _HARD

        inside = kind != _SPACE
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:]
        starts = begins.copy()
        starts[1:] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        self.hard_starts = np.zeros(0, dtype=np.int64)
        if hard or len(special):
            words = np.flatnonzero(begins)
            word = np.cumsum(begins) - 1
            judged = np.zeros(len(words), dtype=bool)
            judged[word[np.flatnonzero(kind == _HARD)]] = True
            mine = inside & judged[word] if len(words) else inside
            starts &= ~mine | begins
            self.low = np.where(mine, data, self.low)
            self.hard_starts = words[judged]
            kind = np.where(mine, np.uint8(_HARD), kind)
        self._contract(kind, begins, starts)
        edges = np.flatnonzero(starts)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | starts[1:]
        self.starts, self.ends = edges, np.flatnonzero(last) + 1
        self.text = np.searchsorted(texts.bounds, self.starts, side="right") - 1

    def _contract(self, kind: np.ndarray, begins: np.ndarray, starts: np.ndarray) -> None:
        """An apostrophe that begins a piece takes the letters of a contraction with it."""
        size = len(kind)
        marks = np.flatnonzero((self.low == 0x27) & (kind == _OTHER) & starts)
        marks = marks[marks < size - 1]
        # the letter belongs to the same word
        marks = marks[(kind[marks + 1] == _LETTER) & ~begins[marks + 1]]
        letter = self.low[marks + 1]
        short = np.isin(letter, np.frombuffer(b"stmd", np.uint8))
        starts[marks[short] + 1] = False
        self._open(kind, starts, _after(marks[short], 2, size))
        long = marks[~short & (marks < size - 2)]
        long = long[(kind[long + 2] == _LETTER) & ~begins[long + 2]]
        pair = self.low[long + 1].astype(np.uint16) << 8 | self.low[long + 2]
        long = long[np.isin(pair, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])]
        starts[long + 1] = False
        self._open(kind, starts, _after(long, 3, size))

    @staticmethod
    def _open(kind: np.ndarray, starts: np.ndarray, places: np.ndarray) -> None:
        """What follows a contraction in its word is a piece of its own."""
        starts[places[kind[places] != _SPACE]] = True


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Encoder:
    """Ids as the library gives them, but every distinct piece of a chunk is encoded only once, and
    pieces are found, told apart and put together as arrays, without a Python object for each.

    A file whose rules are not those this module cuts by goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = _cuts_here(path)
        # the vocabulary marks the last part of a word
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(words.values()) + 1, dtype=bool)
        self.ends_word[[i for word, i in words.items() if word.endswith(_WORD_END)]] = True
        # what is remembered: hashes of pieces, ascending, with their numbers; by number a piece's bytes,
        # its place in one long row of ids, and how many chunks it was in
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.names = np.zeros(0, dtype=np.uint8)
        self.ids = np.zeros(0, dtype="<u4")
        empty = np.zeros(0, dtype=np.int64)
        self.number = self.lengths = self.offsets = self.chunks = self.name_ends = self.name_sizes = empty

    def _forget(self, kept: np.ndarray) -> None:
        """Remember only the pieces of these numbers."""
        renamed = np.full(len(self.lengths), -1, dtype=np.int64)
        renamed[kept] = np.arange(len(kept))
        left = renamed[self.number] >= 0
        self.hashes, self.number = self.hashes[left], renamed[self.number[left]]
        self.ids = self.ids[_ranges(self.offsets[kept], self.lengths[kept])]
        self.names = self.names[_ranges(self.name_ends[kept] - self.name_sizes[kept], self.name_sizes[kept])]
        self.lengths, self.name_sizes = self.lengths[kept], self.name_sizes[kept]
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.name_ends = np.cumsum(self.name_sizes)
        self.chunks = np.zeros(len(kept), dtype=np.int64)

    def _find(self, hashes: np.ndarray, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of known pieces, -1 of others; bytes decide, not hashes."""
        numbers = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            like = np.flatnonzero(self.hashes[at] == hashes)
            found = self.number[at[like]]
            equal = self.name_sizes[found] == sizes[like]
            like, found = like[equal], found[equal]
            theirs = _ranges(self.name_ends[found] - sizes[like], sizes[like])
            differ = self.names[theirs] != low[_ranges(starts[like], sizes[like])]
            if differ.any():
                bad = np.unique(np.repeat(np.arange(len(like)), sizes[like])[differ])
                like, found = np.delete(like, bad), np.delete(found, bad)
            numbers[like] = found
        return numbers

    def _library(self, pieces: list[bytes], hard: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of pieces, and the ids of all, from the library.

        A piece cut here is one word to the library, so many of them go in as one text, and ids that
        end a word say where each ends. Others go in by themselves.
        """
        counts, ids = np.zeros(len(pieces), dtype=np.int64), []
        plain = [i for i, own in enumerate(hard) if not own]
        for first in range(0, len(plain), 4000):
            part = plain[first : first + 4000]
            text = b" ".join(pieces[i] for i in part).decode()
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[found])
            if len(ends) != len(part) or ends[-1] != len(found) - 1:
                raise ValueError("the vocabulary does not cut words as its rules say")
            counts[part] = np.diff(ends, prepend=-1)
            ids.append(found)
        own = [i for i, alone in enumerate(hard) if alone]
        for first in range(0, len(own), 1000):
            part = own[first : first + 1000]
            texts = [pieces[i].decode() for i in part]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            counts[part] = [len(x) for x in found]
            ids += [np.array(x.ids, "<u4") for x in found]
        # back into the order of the pieces
        given = np.array(plain + own, dtype=np.int64)
        starts = np.zeros(len(pieces), dtype=np.int64)
        starts[given] = np.cumsum(counts[given]) - counts[given]
        flat = np.concatenate([np.zeros(0, "<u4"), *ids])
        return counts, flat[_ranges(starts, counts)]

    def _numbers(
        self, hashes: np.ndarray, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hard: np.ndarray
    ) -> np.ndarray:
        """The number of each of these distinct pieces; what is not known yet is learnt. When the
        memory is full, pieces that were in one chunk only go first."""
        numbers = self._find(hashes, low, starts, sizes)
        fresh = np.flatnonzero(numbers < 0)
        size = len(self.lengths)
        if len(fresh) and size and size + len(fresh) > REMEMBERED:
            self.chunks[numbers[numbers >= 0]] += 1
            kept = np.flatnonzero(self.chunks > 1)
            self._forget(kept if len(kept) + len(fresh) <= REMEMBERED else kept[:0])
            numbers = self._find(hashes, low, starts, sizes)
            fresh, size = np.flatnonzero(numbers < 0), len(self.lengths)
        if len(fresh):
            data = low.tobytes()
            ranges = zip(starts[fresh].tolist(), (starts[fresh] + sizes[fresh]).tolist())
            counts, ids = self._library([data[a:b] for a, b in ranges], hard[fresh].tolist())
            order = np.argsort(hashes[fresh])
            new = np.arange(size, size + len(fresh))
            at = np.searchsorted(self.hashes, hashes[fresh][order])
            self.hashes = np.insert(self.hashes, at, hashes[fresh][order])
            self.number = np.insert(self.number, at, new[order])
            self.offsets = np.concatenate([self.offsets, len(self.ids) + np.cumsum(counts) - counts])
            self.lengths = np.concatenate([self.lengths, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.name_ends = np.concatenate([self.name_ends, len(self.names) + np.cumsum(sizes[fresh])])
            self.name_sizes = np.concatenate([self.name_sizes, sizes[fresh]])
            self.names = np.concatenate([self.names, low[_ranges(starts[fresh], sizes[fresh])]])
            self.chunks = np.concatenate([self.chunks, np.zeros(len(fresh), dtype=np.int64)])
            numbers[fresh] = new
        self.chunks[numbers] += 1
        return numbers

    def encode_texts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids of all."""
        if not self.cuts:
            whole = [texts.data[a:b].tobytes().decode() for a, b in zip(texts.bounds[:-1], texts.bounds[1:])]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            counts = np.array([len(x) for x in found], dtype=np.int64)
            return counts, np.array([i for x in found for i in x], dtype="<u4")
        pieces = Pieces(texts)
        starts, lengths = pieces.starts, pieces.ends - pieces.starts
        if not len(starts):
            return np.zeros(texts.count, dtype=np.int64), np.zeros(0, "<u4")
        hashes = range_hashes(pieces.low, starts, pieces.ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not _same(pieces.low, starts, lengths, first[which]):
            first, which = _by_bytes(pieces.low, starts, pieces.ends)
            distinct = hashes[first]
        hard = np.isin(starts[first], pieces.hard_starts)
        number = self._numbers(distinct, pieces.low, starts[first], lengths[first], hard)
        lengths, offsets = self.lengths[number][which], self.offsets[number][which]
        counts = np.bincount(pieces.text, weights=lengths, minlength=texts.count).astype(np.int64)
        return counts, self.ids[_ranges(offsets, lengths)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for chunk in text_chunks(pa.array(texts, pa.string()), PIECE_BYTES):
            counts, ids = self.encode_texts(chunk)
            ends = np.cumsum(counts)
            out += [ids[b - n : b].tobytes() for n, b in zip(counts, ends)]
        return out


def _cuts_here(path: str) -> bool:
    """Whether a vocabulary's rules are the ones that Pieces follows."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    split = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    special = [x["content"] for x in rules.get("added_tokens", [])]
    return (
        rules.get("normalizer") == _NORMALIZER
        and split.get("type") == "Split"
        and split.get("pattern") == {"Regex": _SPLIT}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and rules["model"].get("end_of_word_suffix") == _WORD_END
        and all(x.startswith("<|") and not re.search(r"\s", x) for x in special)
    )


def _same(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray, like: np.ndarray) -> bool:
    """Whether every piece has the bytes of the one that stands for it."""
    if (lengths != lengths[like]).any():
        return False
    return bool((low[_ranges(starts, lengths)] == low[_ranges(starts[like], lengths)]).all())


def _by_bytes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and numbers of distinct pieces, by their bytes: for hashes that collide."""
    data, seen = low.tobytes(), {}
    which = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts, ends)])
    return np.unique(which, return_index=True)[1], which


def _segments(texts: Texts) -> Iterator[tuple[Texts, bool]]:
    """A chunk, or a text longer than that in parts that end at white space; True: the text ends."""
    data, at, size = texts.data, 0, len(texts.data)
    while texts.count == 1 and size - at > PIECE_BYTES:
        space = _WHITE.search(data[at : at + PIECE_BYTES].tobytes())
        found = None if space is None else at + space.start()
        if found is None:  # a very long word: it ends where it ends
            rest = np.flatnonzero(_CLASS[data[at + PIECE_BYTES :]] == _SPACE)
            if not len(rest):
                break
            found = at + PIECE_BYTES + int(rest[0])
        yield Texts(texts.first, data[at : found + 1], np.array([0, found + 1 - at])), False
        at = found + 1
    yield (Texts(texts.first, data[at:], np.array([0, size - at])) if at else texts), True


def _whole_rows(encoder: Encoder, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, number of ids of each text, their ids) of all texts of a column, in order."""
    for texts in text_chunks(column, PIECE_BYTES):
        before = []
        for part, ends in _segments(texts):
            counts, ids = encoder.encode_texts(part)
            if ends and not before:
                yield texts.first, counts, ids
            elif ends:
                ids = np.concatenate([*before, ids])
                yield texts.first, np.array([len(ids)]), ids
            else:
                before.append(ids)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_ROW = "doc_id bigint, file_no int, local_start bigint, n_tokens bigint, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start, file_no = _encoder(path), 0, TaskContext.get().partitionId()
        for batch in batches:
            for first, counts, ids in _whole_rows(encoder, batch.column(1)):
                rows, ends = len(counts), np.concatenate([[0], np.cumsum(counts + 1)])
                # an end id after each text's ids
                out = np.full(int(ends[-1]), end_id, dtype="<u4")
                out[_ranges(ends[:-1], counts)] = ids
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.full(rows, file_no, dtype=np.int32)),
                        pa.array(start + ends[:-1]),
                        pa.array(counts + 1),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.view("<i4"))),
                    ],
                    ["doc_id", "file_no", "local_start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    return run


def _checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ids, bounds = np.asarray(lists.values, dtype="<i4"), np.asarray(lists.offsets)
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "file_no", "local_start", "n_tokens", "ids_crc32"],
        )


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES
) -> None:
    """Encode every whole text of docs (doc_id, text) and write it below path.

    A null text counts as empty; every document ends with end_id. Files follow one another in
    doc_id order (nulls first), and so do the rows of a file; rows with equal doc_id stay together in the
    order of a hash of their text. Other columns of docs are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(max(1, -(-total // file_bytes)), *order)
    tokens = ranged.sortWithinPartitions(*order).mapInArrow(_encode(vocabulary, end_id), _ROW)
    (
        tokens.write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("compression", "zstd")
        .parquet(path)
    )


#: Files whose starts are added up in one task.
_FILES = 1_000


def read_token_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, before): ids in the files before each. Reads two columns; running sums in two levels,
    within _FILES files and over their totals, so no task and not the driver sees every file."""
    files = spark.read.parquet(path).groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    files = files.withColumn("block", F.floor(F.col("file_no") / _FILES))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("block").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(within), F.lit(0))
    return files.select("file_no", "block", inside.alias("inside")).join(blocks, "block").select(
        "file_no", (F.col("start") + F.col("inside")).alias("before")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids); start counts the ids of all documents before it."""
    rows = spark.read.parquet(path).join(read_token_starts(spark, path), "file_no")
    start = (F.col("before") + F.col("local_start")).alias("start")
    return rows.select("doc_id", start, "n_tokens", "ids")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read from the files."""
    files = spark.read.parquet(path).select("doc_id", "file_no", "local_start", "ids")
    sums = files.mapInArrow(
        _checksum,
        "doc_id bigint, file_no int, local_start bigint, n_tokens bigint, ids_crc32 bigint",
    )
    start = (F.col("before") + F.col("local_start")).alias("start")
    return sums.join(read_token_starts(spark, path), "file_no").select(
        "doc_id", start, "n_tokens", "ids_crc32"
    )


def tokenised(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the token files of docs to shared storage and return the digest read from them."""
    spark = docs.sparkSession
    path = new_folder(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return token_digest(spark, path)
