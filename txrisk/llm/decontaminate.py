"""Benchmark passages in documents: SimHash of item-sized windows, a multi-index over Hamming blocks,
and exact weighted-shingle similarity for what is near.

A window has as many words as a benchmark item. A fingerprint of 64 bits is the sign of the votes of
its five-word shingles, each as often as it occurs. Windows that share no shingle with an item have
similarity 0 to it, so only windows around a shared shingle are fingerprinted. Fingerprints of items
of one length are indexed in BLOCKS blocks: within RADIUS bits of each other, two fingerprints differ
in some block by at most RADIUS // BLOCKS bits. What is within the radius is compared exactly: the
sum of the lesser shingle counts over the sum of the greater ones.

At a similarity of 0.8 fingerprints are 10 bits apart with a deviation of 3, so 1 in 100,000 windows
is missed at the threshold, and fewer above it; a copied passage is met by many windows. A document
of fewer words than an item is one window, compared exactly without a fingerprint.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64, Texts, find_words, fold, mix, text_chunks

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 22
BLOCKS = 4
#: Items are read to the driver and sent to tasks in groups of about this many bytes of text.
ITEM_BYTES = 8 << 20
_FILTER_BITS = 20


def fingerprints(hashes: np.ndarray, counts: int) -> np.ndarray:
    """SimHash of every run of `counts` consecutive shingle hashes."""
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=sums[1:])
    votes = sums[counts:] - sums[:-counts]
    return np.packbits(votes > 0, axis=1).view(np.uint64).reshape(-1)


class Items:
    """Items of one group by number: their shingles, fingerprints by length, and who has which shingle."""

    def __init__(self, items: list[tuple[int, str]], k: int = SHINGLE) -> None:
        self.k = k
        self.shingles: dict[int, np.ndarray] = {}
        self.words: dict[int, int] = {}
        owners: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            for texts in text_chunks(pa.array([text])):
                hashes = find_words(texts).hashes
                if not len(hashes):
                    continue
                size = min(k, len(hashes))
                grams = fold([hashes[j : len(hashes) - size + 1 + j] for j in range(size)], size)
                self.shingles[item_id], self.words[item_id] = grams, len(hashes)
                for gram in grams.tolist():
                    owners[size][gram].add(item_id)
        self.owners = {size: dict(found) for size, found in owners.items()}
        self.known = {s: np.array(sorted(found), dtype=np.uint64) for s, found in owners.items()}
        self.filters = {}
        for size, known in self.known.items():
            self.filters[size] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self.filters[size][known >> U64(64 - _FILTER_BITS)] = True
        self.by_words = defaultdict(list)
        for item_id, n in self.words.items():
            self.by_words[n].append(item_id)
        self.prints = {
            n: np.concatenate([fingerprints(self.shingles[i], len(self.shingles[i])) for i in ids])
            for n, ids in self.by_words.items()
        }

    def near(self, prints: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[int, int]]:
        """(window, item) of all fingerprints within the radius, for items of n words."""
        items, width = self.prints[n], 64 // BLOCKS
        found: set[tuple[int, int]] = set()
        for first in range(0, len(prints), 4096):
            part = prints[first : first + 4096]
            for b in range(BLOCKS):
                mask = U64((1 << width) - 1)
                values, where = np.unique((items >> U64(b * width)) & mask, return_inverse=True)
                own = (part >> U64(b * width)) & mask
                close = np.bitwise_count(own[:, None] ^ values[None, :]) <= radius // BLOCKS
                x, y = np.nonzero(close[:, where])
                within = np.bitwise_count(part[x] ^ items[y]) <= radius
                found.update(zip((x[within] + first).tolist(), y[within].tolist()))
        return [(x, self.by_words[n][y]) for x, y in found]

    def matches(self, texts: Texts, least: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, similarity, first word, windows) of each text and item with a window of at
        least that similarity; the most similar window counts, the first of equals. A text of fewer
        words than the item is one window."""
        words = find_words(texts)
        n = len(words.hashes)
        for size, known in self.known.items():
            if n < size:
                continue
            grams = fold([words.hashes[j : n - size + 1 + j] for j in range(size)], size)
            whole = words.text[: n - size + 1] == words.text[size - 1 :]
            hits = np.flatnonzero(self.filters[size][grams >> U64(64 - _FILTER_BITS)] & whole)
            at = np.minimum(np.searchsorted(known, grams[hits]), len(known) - 1)
            hits = hits[known[at] == grams[hits]]
            regions = defaultdict(list)
            shorter: dict[tuple[int, int], int] = defaultdict(int)
            for p in hits.tolist():
                text = int(words.text[p])
                n_words = int(words.bounds[text + 1] - words.bounds[text])
                for item in self.owners[size][int(grams[p])]:
                    if self.words[item] > n_words:
                        shorter[text, item] += 1
                    elif min(self.k, self.words[item]) == size:
                        regions[self.words[item], text].append(p)
            for (length, text), places in regions.items():
                low, high = int(words.bounds[text]), int(words.bounds[text + 1])
                yield from self._in_text(grams, length, size, text, low, high, places, least)
            for (text, item), n_shared in shorter.items():
                # no more than n_shared of the item's shingles are common to both
                if n_shared / len(self.shingles[item]) >= least:
                    low, high = int(words.bounds[text]), int(words.bounds[text + 1])
                    sim = weighted_similarity(grams[low : high - size + 1], self.shingles[item])
                    if sim >= least:
                        yield text, item, sim, 0, 1

    def _in_text(self, grams, length, size, text, low, high, places, least):
        span = length - size + 1
        places = np.unique(places)
        # starts of windows that hold a shared shingle
        starts = np.unique((places[:, None] - np.arange(span)).reshape(-1))
        starts = starts[(starts >= low) & (starts <= high - length)]
        prints = []
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            if len(run):
                prints.append(fingerprints(grams[run[0] : run[-1] + span], span))
        if not prints:
            return
        best: dict[int, tuple[float, int]] = {}
        count: dict[int, int] = defaultdict(int)
        for x, item in sorted(self.near(np.concatenate(prints), length)):
            start = int(starts[x])
            sim = weighted_similarity(grams[start : start + span], self.shingles[item])
            if sim >= least:
                count[item] += 1
                if item not in best or sim > best[item][0]:
                    best[item] = sim, start - low
        for item, (sim, first) in best.items():
            yield text, item, sim, first, count[item]


def weighted_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Of two multisets of shingles: the sum of lesser counts over the sum of greater ones."""
    values, where = np.unique(np.concatenate([x, y]), return_inverse=True)
    a = np.bincount(where[: len(x)], minlength=len(values))
    b = np.bincount(where[len(x) :], minlength=len(values))
    return float(np.minimum(a, b).sum() / np.maximum(a, b).sum())


_MATCH = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_windows bigint"


def _numbered(group: list[tuple[int | None, str]]) -> Items:
    return Items([(number, text) for number, (_, text) in enumerate(group)])


def _searcher(group: list[tuple[int | None, str]], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _numbered(group)
        for batch in batches:
            for texts in text_chunks(batch.column(1)):
                rows = list(items.matches(texts, least))
                if rows:
                    at, item, sim, first, count = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.array(at) + texts.first)),
                            pa.array([group[number][0] for number in item], pa.int64()),
                            pa.array(sim, pa.float64()),
                            pa.array(first, pa.int64()),
                            pa.array(count, pa.int64()),
                        ],
                        ["doc_id", "item_id", "similarity", "first_word", "n_windows"],
                    )

    return run


def item_groups(benchmark: DataFrame, item_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's different items (item_id, text), also those without an item_id, in groups of
    about item_bytes, one at a time; at least one."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    items = items.where("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // item_bytes))
    for g in range(groups):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g)
        yield [tuple(row) for row in part.orderBy("item_id", "text").collect()]


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_windows): each pair of a row of docs (doc_id,
    text) and an item (item_id, text) where a window of the document's words, as long as the item,
    has at least that similarity; the place and similarity of the best window, and their number.

    Words are runs of bytes other than space and 0x09 to 0x0D, A-Z lowered. Items of fewer than five
    words are one shingle and match verbatim. Null and empty texts match nothing. A document of fewer
    words than an item is its one window; below the words of a shingle it shares none. Different
    texts of one item_id are found each. Items without an item_id are left out, as a pair cannot name
    them; without_matches() searches them too. Rows that repeat a document are found each; an item
    that repeats both item_id and text counts once. A null doc_id is carried along. Other columns are not read.

    The benchmark goes to the tasks in groups of bounded size, by a pass over the documents for
    each group, so it may be of any size. Documents are not shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    benchmark = benchmark.where(F.col("item_id").cast("bigint").isNotNull())
    for group in item_groups(benchmark, item_bytes):
        hits = rows.mapInArrow(_searcher(group, least), _MATCH)
        found = hits if found is None else found.union(hits)
    return found


def without_matches(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs, all columns as they are, that hold no benchmark passage."""
    for group in item_groups(benchmark, ITEM_BYTES):
        docs = docs.mapInArrow(_remover(group, least, docs.columns.index("text")), docs.schema)
    return docs


def _remover(group: list[tuple[int, str]], least: float, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _numbered(group)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for texts in text_chunks(batch.column(place)):
                for found in items.matches(texts, least):
                    keep[texts.first + found[0]] = False
            yield batch.filter(pa.array(keep))

    return run
