"""Quality rules: counts of each whole text, and isolation forests over statistics made of them.

Random splits isolate an unusual document after few of them: the score is 2 ** (-mean path length /
path length expected for the sample), near 1 for anomalies. One forest splits on the shape of a text
as a whole; each statistic also has a small forest of its own, so that documents with one fault are
not hidden by all that is usual about them. Forests grow from a bounded sample of documents. Their
thresholds are calibrated together on all labelled rows: they find most labelled bad documents while
all of them lose at most MAX_LOSS of the labelled good ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hash_sample, stored
from .words import Texts, find_words, fold, mix, range_hashes, text_chunks

TREES = 200
#: Few rows a tree, so that many documents with one fault don't hide each other.
TREE_ROWS = 64
#: Trees of a forest on one statistic, and rows of each.
SINGLE_TREES, SINGLE_ROWS = 100, 32
#: Rows the trees draw from.
FOREST_ROWS = 20_000
#: Share of labelled good documents that the thresholds may lose, all together.
MAX_LOSS = 0.002
#: Labelled bad documents that a forest has to find beyond all good ones, or it has no say.
LEAST_FOUND = 3
#: Scores are told apart, counted and compared in so many steps.
LEVELS = 1 << 12

_WINDOW = 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: first bytes of code points
_POINT = (np.arange(256) & 0xC0) != 0x80

_DIGIT, _UPPER, _PUNCTUATION = (np.zeros(256, dtype=bool) for _ in range(3))
_DIGIT[ord("0") : ord("9") + 1] = True
_UPPER[ord("A") : ord("Z") + 1] = True
_PUNCTUATION[list(b".,;:!?")] = True

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words "
    "n_lines n_points n_digits n_upper n_punctuation n_distinct"
).split()
STATISTICS = (
    "word length", "symbols", "repeated words", "words a line",
    "duplicate lines", "digits", "capitals", "punctuation", "distinct words", "words",
)
#: Statistics that the shape forest splits on together.
SHAPE = (0, 1, 2, 3)


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(values: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Number of different values of each owner."""
    keys = mix(values ^ mix(owner.astype(np.uint64)))
    _, at = np.unique(keys, return_index=True)
    return np.bincount(owner[at], minlength=count)


def text_counts(texts: Texts) -> np.ndarray:
    """One row of COUNTS for each text."""
    words = find_words(texts, lower=False)
    data, bounds, n = texts.data, texts.bounds, texts.count
    point_sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_POINT[data], out=point_sums[1:])
    chars = np.zeros(n, dtype=np.int64)
    np.add.at(chars, words.text, point_sums[words.ends] - point_sums[words.starts])

    # lines: from a text's begin or a line feed to the next; those with a word, by hash
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    line_of_word = np.searchsorted(starts, words.starts, side="right") - 1
    lines, first = np.unique(line_of_word, return_index=True)
    dup_lines = np.zeros(n, dtype=np.int64)
    line_text = np.zeros(0, np.int64)
    if len(lines):
        line_text = words.text[first]
        ends = np.append(starts[1:], len(data))[lines]
        # without the line feed; the last line of a text has none
        ends = ends - (data[ends - 1] == 0x0A)
        hashes = range_hashes(data, starts[lines], ends)
        dup_lines = np.bincount(line_text, minlength=n) - _distinct(hashes, line_text, n)

    repeat = np.zeros(n, dtype=np.int64)
    m = len(words.hashes) - _WINDOW + 1
    if m > 0:
        whole = np.flatnonzero(words.text[:m] == words.text[_WINDOW - 1 :])
        grams = fold([words.hashes[whole + j] for j in range(_WINDOW)], _WINDOW)
        keys = mix(grams ^ mix(words.text[whole].astype(np.uint64)))
        _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = whole[times[inverse] > 1]
        marks = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        np.add.at(marks, again, 1)
        np.add.at(marks, again + _WINDOW, -1)
        covered = np.cumsum(marks)[:-1] > 0
        repeat = np.bincount(words.text[covered], minlength=n)
    return np.stack(
        [
            np.diff(words.bounds),
            chars,
            _sums(_SYMBOL[data], bounds),
            dup_lines,
            repeat,
            np.bincount(line_text, minlength=n),
            np.diff(point_sums[bounds]),
            _sums(_DIGIT[data], bounds),
            _sums(_UPPER[data], bounds),
            _sums(_PUNCTUATION[data], bounds),
            _distinct(words.hashes, words.text, n),
        ],
        axis=1,
    ).astype(np.int64)


def statistics(counts: np.ndarray) -> np.ndarray:
    """The columns of STATISTICS: lengths on a log scale, and ratios."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64)))
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    chars = np.maximum(c["word_chars"], 1)
    return np.stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_repeat_words"] / words,
            np.log1p(c["n_words"] / lines),
            c["n_dup_lines"] / lines,
            c["n_digits"] / chars,
            c["n_upper"] / chars,
            c["n_punctuation"] / words,
            # distinct words fall with length by themselves
            np.log(np.maximum(c["n_distinct"], 1)) / np.log(words + 1),
            np.log1p(c["n_words"]),
        ],
        axis=1,
    )


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    long = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays of nodes: the split column (-1: leaf), its value, the left child (the right
    one follows it), and in a leaf the path length."""

    column: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        at_row = np.arange(len(x))
        for column, value, child, path in zip(self.column, self.value, self.child, self.path):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                split = column[node]
                right = x[at_row, np.maximum(split, 0)] >= value[node]
                node = np.where(split < 0, node, child[node] + right)
            total += path[node]
        return 2.0 ** (-total / len(self.column) / max(float(_expected_path(self.rows)), 1.0))


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS) -> Forest:
    """A forest over a sample; the same sample in the same order gives the same forest."""
    rng = np.random.default_rng(11)
    rows = min(rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (depth + 1)
    column = np.full((trees, size), -1)
    value, path = np.zeros((trees, size)), np.zeros((trees, size))
    child = np.zeros((trees, size), dtype=np.int64)
    for t in range(trees):
        free, stack = 1, [(0, x[rng.choice(len(x), rows, replace=False)], 0)]
        while stack:
            node, part, level = stack.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if level == depth or not len(usable):
                path[t, node] = level + float(_expected_path(len(part)))
                continue
            j = rng.choice(usable)
            cut = rng.uniform(low[j], high[j])
            column[t, node], value[t, node], child[t, node] = j, cut, free
            right = part[:, j] >= cut
            stack += [(free, part[~right], level + 1), (free + 1, part[right], level + 1)]
            free += 2
            if not right.any() or right.all():  # a cut at the very edge
                column[t, node], free = -1, free - 2
                del stack[-2:]
                path[t, node] = level + float(_expected_path(len(part)))
    return Forest(column, value, child, path, depth, rows)


@dataclass
class Steps:
    """A forest on one statistic as the step function that it is."""

    cuts: np.ndarray
    heights: np.ndarray

    @classmethod
    def of(cls, forest: Forest) -> Steps:
        cuts = np.unique(forest.value[forest.column >= 0])
        return cls(cuts, forest.scores(np.concatenate([[-np.inf], cuts])[:, None]))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.heights[np.searchsorted(self.cuts, x, side="right")]


@dataclass
class Judge:
    """The shape forest and one forest for each statistic; limits: the level each rejects from."""

    shape: Forest
    singles: list[Steps]
    limits: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """A row for each text: the score of the shape forest, then of each statistic's."""
        x = statistics(counts)
        singles = [forest.scores(x[:, j]) for j, forest in enumerate(self.singles)]
        return np.stack([self.shape.scores(x[:, SHAPE]), *singles], axis=1)

    def levels(self, counts: np.ndarray) -> np.ndarray:
        return np.minimum((self.scores(counts) * LEVELS).astype(np.int64), LEVELS - 1)


def grow_judge(counts: np.ndarray) -> Judge:
    """Forests over a sample of counts, without limits yet: nothing is rejected."""
    x = statistics(counts)
    singles = [
        Steps.of(grow(x[:, [j]], SINGLE_TREES, SINGLE_ROWS)) for j in range(len(STATISTICS))
    ]
    return Judge(grow(x[:, SHAPE]), singles, np.full(1 + len(singles), LEVELS))


def limits(good: np.ndarray, bad: np.ndarray, max_loss: float = MAX_LOSS) -> np.ndarray:
    """The level each forest rejects from, given labelled good and bad rows by forest and level.

    Limits begin above every good row. Then, while the loss of all limits allows, the limit that
    finds most bad rows for a good one lost goes down to below the next good row. A forest that finds
    fewer than LEAST_FOUND bad rows rejects nothing, as does every forest without good or bad rows.
    """
    forests, levels = good.shape
    off = np.full(forests, levels)
    rows = int(good[0].sum())
    if rows == 0 or int(bad[0].sum()) == 0:
        return off
    # good levels of each forest from the top; a limit lies just above one of them
    steps = [np.append(np.flatnonzero(g)[::-1], -1) for g in good]
    at, left = np.zeros(forests, dtype=int), int(max_loss * rows)
    place = [int(own[0]) + 1 for own in steps]
    while True:
        best = (0.0, 0, 0, 0)
        for f in range(forests):
            found = lost = 0
            # one step may find nothing by itself and the next one much
            for step in range(at[f] + 1, min(at[f] + 20, len(steps[f]))):
                lost = int(good[f, steps[f][step] + 1 : place[f]].sum())
                if lost > left:
                    break
                found = int(bad[f, steps[f][step] + 1 : place[f]].sum())
                best = max(best, (found / lost, f, step, lost))
        if best[0] <= 0:
            break
        _, f, step, lost = best
        at[f], place[f], left = step, int(steps[f][step]) + 1, left - lost
    found = np.array([bad[f, place[f] :].sum() for f in range(forests)])
    return np.where(found >= LEAST_FOUND, place, levels)


_COUNTED = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in text_chunks(batch.column(1)):
            counts = text_counts(texts)
            ids = batch.column(0).slice(texts.first, texts.count)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c) for c in counts.T)], ["doc_id", *COUNTS]
            )


_FORESTS = 1 + len(STATISTICS)


def _labelled_levels(judge: Judge):
    """Labelled rows by forest, level and label, counted over a partition; those that the base rules
    reject do not count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _FORESTS, LEVELS), dtype=np.int64)
        for batch in batches:
            counts = _columns(batch)
            passing = ~((counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0]))
            quality = np.asarray(batch.column("quality")).astype(np.int64)[passing]
            levels = judge.levels(counts[passing])
            for f in range(_FORESTS):
                np.add.at(total[:, f], (quality, levels[:, f]), 1)
        flat = total.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

    return run


def _scorer(judge: Judge | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _columns(batch)
            scores = judge.scores(counts) if judge and len(counts) else np.zeros((len(counts), _FORESTS))
            levels = np.minimum((scores * LEVELS).astype(np.int64), LEVELS - 1)
            against = levels >= judge.limits if judge else levels > LEVELS
            names = np.array(["shape", *STATISTICS], dtype=object)
            first = np.where(against.any(axis=1), names[against.argmax(axis=1)], None)
            columns = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores[:, 0]), pa.array(first, pa.string())],
                [*batch.schema.names, "anomaly", "rejected_by"],
            )

    return run


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.asarray(batch.column(c)) for c in COUNTS], axis=1)


def calibrated(counted: DataFrame, labels: DataFrame, judge: Judge) -> Judge:
    """The judge with limits from every labelled row. Only counts by forest, level and label leave the
    tasks, a number that does not grow with the rows."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    known = known.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    judged = counted.join(known, "doc_id").select(*COUNTS, "quality")
    found = judged.mapInArrow(_labelled_levels(judge), "at bigint, n bigint")
    found = found.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(2 * _FORESTS * LEVELS, dtype=np.int64)
    total[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    bad, good = total.reshape(2, _FORESTS, LEVELS)
    return Judge(judge.shape, judge.singles, limits(good, bad))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, anomaly,
    rejected_by, kept) for each row of docs (doc_id, text); labels has doc_id and quality (1: good).

    Words are runs of bytes other than space and 0x09 to 0x0D, as written. A null text counts as
    empty; it has no words and fails the base rules. Rows without a doc_id are judged like others;
    repeated rows get equal verdicts; of repeated labels the lowest counts. Without labelled good
    and bad rows the forests reject nothing. `anomaly` is the score of the shape forest, `rejected_by`
    the first forest whose limit a row reaches (null if none). Other columns are not read.

    Counting is one pass over the texts without a shuffle; what is kept of a document is a few
    numbers. Trees draw from FOREST_ROWS documents, limits come from all labelled rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = stored(rows.mapInArrow(_counter, _COUNTED), "counts")
    sample = hash_sample(counted, FOREST_ROWS, "forest", "doc_id", *COUNTS).toPandas()
    judge = grow_judge(sample[COUNTS].to_numpy(np.int64)) if len(sample) else None
    if judge:
        judge = calibrated(counted, labels, judge)

    base_failed = (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    )
    scored = counted.mapInArrow(_scorer(judge), f"{_COUNTED}, anomaly double, rejected_by string")
    return scored.select(
        "doc_id",
        *COUNTS[:5],
        base_failed.alias("base_failed"),
        "anomaly",
        "rejected_by",
        (~base_failed & F.col("rejected_by").isNull()).alias("kept"),
    )
