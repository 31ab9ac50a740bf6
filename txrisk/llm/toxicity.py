"""Toxicity of whole documents: a bidirectional gated recurrent network over character and word
inputs, with attention pooling, trained in numpy and run over all overlapping windows.

Inputs of a word are smoothed log-odds of the word and of its characters: its beginnings of 4, 6 and
8 bytes, its end of 4 bytes, and the mean over its byte trigrams. The network learns from each half
of the labelled sample with log-odds counted in the other half, so a word that is toxic only by
accident of its own document teaches nothing; it scores with those of both. It reads windows of
WINDOW words every STRIDE words. A document's score is a logistic function of its largest window, of
its three largest, and of the mean of all, fitted in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import hash_sample, stored
from .words import _LOWER_CODES, _POWERS, U64, Texts, find_words, mix, text_chunks

#: At most so many labelled documents are learnt from.
SAMPLE_ROWS = 12_000
#: At most so many windows of a labelled document train the network.
SAMPLE_WINDOWS = 3
WINDOW = 32
STRIDE = 16
THRESHOLD = 0.7
BUCKETS = 1 << 17
INPUTS = 6
HIDDEN = 8
LEAST_STEPS = 600
_PREFIXES = (4, 6, 8)


def word_buckets(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table places of each word (5 columns), of each byte trigram, and first words of the texts.

    The last array also carries, per word, its byte range: rows of (start, end)."""
    words = find_words(texts)
    size = len(texts.data)
    up, down = _POWERS.upto(size + 1)
    sums = np.zeros(size + 1, dtype=np.uint64)
    codes = _LOWER_CODES[texts.data]
    np.cumsum(codes * up[:-1], out=sums[1:])

    def place(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (mix((sums[end] - sums[start]) * down[start]) >> U64(47)).astype(np.int32)

    columns = [(words.hashes >> U64(47)).astype(np.int32)]
    columns += [place(words.starts, np.minimum(words.starts + n, words.ends)) for n in _PREFIXES]
    columns.append(place(np.maximum(words.ends - 4, words.starts), words.ends))
    trigrams = np.zeros(size, dtype=np.int32)
    if size > 2:
        grams = codes[:-2] + codes[1:-1] * up[1] + codes[2:] * up[2]
        trigrams[:-2] = (mix(grams) >> U64(47)).astype(np.int32)
    ranges = np.stack([words.starts, words.ends])
    return np.stack(columns), trigrams, (words.bounds, ranges)


def _trigram_means(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Mean of a value at each byte over the trigrams that lie within each word."""
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    starts, ends = ranges
    last = np.maximum(ends - 2, starts + 1)
    return (sums[last] - sums[starts]) / (last - starts)


@dataclass
class Network:
    """tables: log-odds by place, one row an input; weights: of the network; pool: of the score."""

    tables: np.ndarray
    weights: dict[str, np.ndarray]
    pool: np.ndarray

    def inputs(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of every word of a chunk, a null word at the end, and first words of the texts."""
        places, trigrams, (bounds, ranges) = word_buckets(texts)
        out = np.zeros((places.shape[1] + 1, INPUTS), dtype=np.float32)
        for j, column in enumerate(places):
            out[:-1, j] = self.tables[j][column]
        out[:-1, -1] = _trigram_means(self.tables[-1][trigrams], ranges)
        return out, bounds

    def window_logits(self, inputs: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """windows: for each window, the places of its words in inputs."""
        w = self.weights
        projected = [inputs @ w[f"x{d}"] + w[f"b{d}"] for d in "fb"]
        out = np.empty(len(windows), dtype=np.float32)
        for first in range(0, len(windows), 2048):
            part = windows[first : first + 2048]
            states = np.empty((WINDOW, len(part), 2 * HIDDEN), dtype=np.float32)
            for k, d in enumerate("fb"):
                h = np.zeros((len(part), HIDDEN), dtype=np.float32)
                for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                    h = _step(projected[k][part[:, t]], h, w[f"h{d}"])[0]
                    states[t, :, k * HIDDEN : (k + 1) * HIDDEN] = h
            out[first : first + 2048] = _pooled(states, w)[0]
        return out

    def document_features(self, texts: Texts) -> np.ndarray:
        inputs, bounds = self.inputs(texts)
        windows, owner = overlapping(bounds)
        logits = self.window_logits(inputs, windows)
        order = np.lexsort((-logits, owner))
        logits = logits[order].astype(np.float64)
        first = np.searchsorted(owner, np.arange(texts.count))
        count = np.bincount(owner, minlength=texts.count)
        sums = np.concatenate([[0.0], np.cumsum(logits)])
        three = np.minimum(count, 3)
        return np.stack(
            [
                logits[first],
                (sums[first + three] - sums[first]) / three,
                (sums[first + count] - sums[first]) / count,
                np.ones(texts.count),
            ],
            axis=1,
        )

    def scores(self, texts: Texts) -> np.ndarray:
        return _sigmoid(self.document_features(texts) @ self.pool)


def overlapping(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, as places of words, and the text of each. A window starts every
    STRIDE words and the last one ends with the text; a text of fewer words than a window, also an
    empty one, has one window filled up with the null word."""
    counts = np.diff(bounds)
    per_text = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = np.minimum(nth * STRIDE, np.maximum(counts[owner] - WINDOW, 0))
    inside = start[:, None] + np.arange(WINDOW)
    places = np.where(inside < counts[owner, None], inside + bounds[owner, None], bounds[-1])
    return places, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(x: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of a gated recurrent unit: x is the projected input, w the recurrent weights."""
    gates = _sigmoid(x[:, : 2 * HIDDEN] + h @ w[:, : 2 * HIDDEN])
    update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    new = np.tanh(x[:, 2 * HIDDEN :] + (reset * h) @ w[:, 2 * HIDDEN :])
    return h + update * (new - h), update, reset, new


def _pooled(states: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Attention over the steps: a window's logit, the attention and the context."""
    e = states @ w["a"]
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    context = np.einsum("tb,tbh->bh", a, states)
    return context @ w["o"] + w["ob"], a, context


def _gradients(
    x: np.ndarray, y: np.ndarray, w: dict[str, np.ndarray]
) -> dict[str, np.ndarray]:
    """Of the mean log-loss over a batch; x is (batch, WINDOW, INPUTS)."""
    n, keep = len(x), {}
    states = np.empty((WINDOW, n, 2 * HIDDEN), dtype=np.float32)
    for k, d in enumerate("fb"):
        h = np.zeros((n, HIDDEN), dtype=np.float32)
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            before = h
            h, update, reset, new = _step(x[:, t] @ w[f"x{d}"] + w[f"b{d}"], h, w[f"h{d}"])
            keep[d, t] = before, update, reset, new
            states[t, :, k * HIDDEN : (k + 1) * HIDDEN] = h
    logit, a, context = _pooled(states, w)
    g = {name: np.zeros_like(value) for name, value in w.items()}
    back = ((_sigmoid(logit) - y) / n).astype(np.float32)
    g["o"], g["ob"] = context.T @ back, back.sum(keepdims=True)
    to_context = back[:, None] * w["o"]
    to_attention = np.einsum("bh,tbh->tb", to_context, states)
    to_e = a * (to_attention - (a * to_attention).sum(axis=0))
    g["a"] = np.einsum("tb,tbh->h", to_e, states)
    to_states = a[:, :, None] * to_context + to_e[:, :, None] * w["a"]
    for k, d in enumerate("fb"):
        carried = np.zeros((n, HIDDEN), dtype=np.float32)
        u = w[f"h{d}"]
        for t in range(WINDOW - 1, -1, -1) if d == "f" else range(WINDOW):
            before, update, reset, new = keep[d, t]
            to_h = carried + to_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            to_new = to_h * update * (1 - new * new)
            to_update = to_h * (new - before) * update * (1 - update)
            through = to_new @ u[:, 2 * HIDDEN :].T
            to_reset = through * before * reset * (1 - reset)
            to_gates = np.concatenate([to_update, to_reset], axis=1)
            carried = to_h * (1 - update) + through * reset + to_gates @ u[:, : 2 * HIDDEN].T
            g[f"h{d}"][:, : 2 * HIDDEN] += before.T @ to_gates
            g[f"h{d}"][:, 2 * HIDDEN :] += (reset * before).T @ to_new
            both = np.concatenate([to_gates, to_new], axis=1)
            g[f"x{d}"] += x[:, t].T @ both
            g[f"b{d}"] += both.sum(axis=0)
    return g


def train(x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 128) -> dict[str, np.ndarray]:
    """Weights fitted by Adam, in LEAST_STEPS steps at least, however few the rows; the same rows in
    the same order give the same weights."""
    rng = np.random.default_rng(7)
    shapes = {"a": (2 * HIDDEN,), "o": (2 * HIDDEN,), "ob": (1,)}
    for d in "fb":
        shapes |= {f"x{d}": (INPUTS, 3 * HIDDEN), f"b{d}": (3 * HIDDEN,), f"h{d}": (HIDDEN, 3 * HIDDEN)}
    w = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
    for name in ("bf", "bb", "ob"):
        w[name][:] = 0
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, steps = 0, max(LEAST_STEPS, -(-len(x) * epochs // batch))
    while step < steps and len(x):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            step += 1
            rate = 0.02 * 0.07 ** (step / steps)
            for k, grad in _gradients(x[rows], y[rows], w).items():
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                slope = first[k] / (1 - 0.9**step)
                w[k] -= rate * slope / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
    return w


def fit_pool(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        w += np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
    return w


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, toxic, half) of at most `rows` labelled documents that are not held out, the
    same ones in every run, in two halves that share each class evenly. Of different texts under one
    doc_id the one with the least digest is learnt from."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    known = known.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    known = hash_sample(known, rows, "sample", "doc_id")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # at most `rows` rows of two numbers each
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic")
    found = stored(found.agg(F.min_by("text", digest).alias("text")), "labelled")
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64(F.lit("half"), "doc_id"), "doc_id"))
    halves = stored(found.select("doc_id", F.pmod(place, F.lit(2)).cast("int").alias("half")), "halves")
    return found.join(F.broadcast(halves), "doc_id")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold each place of each table, summed over a partition."""
    counts = np.zeros((2, INPUTS, BUCKETS), dtype=np.int32)
    for batch in batches:
        toxic = np.asarray(batch.column(1)).astype(np.int64)
        for texts in text_chunks(batch.column(0)):
            places, trigrams, (bounds, _) = word_buckets(texts)
            for i in range(texts.count):
                side = counts[toxic[texts.first + i]]
                for j, column in enumerate(places):
                    side[j][np.unique(column[bounds[i] : bounds[i + 1]])] += 1
                side[-1][np.unique(trigrams[texts.bounds[i] : texts.bounds[i + 1]])] += 1
    flat = counts.reshape(-1)
    at = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at].astype(np.int64))], ["at", "n"])


def presence(sample: DataFrame) -> np.ndarray:
    """Documents of a sample by class, input and place: a fixed number of counters, whatever its size."""
    counts = np.zeros((2, INPUTS, BUCKETS))
    found = sample.select("text", "toxic").mapInArrow(_count, "at bigint, n bigint")
    # as Arrow: a Python object for each of so many counters would be most of the driver's memory
    found = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts.reshape(-1)[found["at"].to_numpy()] = found["n"].to_numpy()
    return counts


def log_odds(counts: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Tables of INPUTS x BUCKETS, smoothed, and drawn to zero where few documents speak."""
    clean, toxic = counts
    share = [(clean + 0.5) / (n_clean + 1), (toxic + 0.5) / (n_toxic + 1)]
    trust = (clean + toxic) / (clean + toxic + 2)
    return (np.clip(np.log(share[1] / share[0]), -6, 6) * trust).astype(np.float32)


def _sample_windows(network: Network):
    """The windows of a document that look most toxic by their inputs alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column(2)):
                inputs, bounds = network.inputs(texts)
                windows, owner = overlapping(bounds)
                best = np.maximum(inputs, 0).sum(axis=1)[windows].max(axis=1)
                order = np.lexsort((-best, owner))
                rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
                pick = order[rank < SAMPLE_WINDOWS]
                at = owner[pick] + texts.first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        batch.column(1).take(pa.array(at)),
                        pa.array([inputs[w].tobytes() for w in windows[pick]], pa.binary()),
                    ],
                    ["doc_id", "toxic", "inputs"],
                )

    return run


def _features(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column(2)):
                found = network.document_features(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, texts.count),
                        batch.column(1).slice(texts.first, texts.count),
                        *(pa.array(found[:, j]) for j in range(3)),
                    ],
                    ["doc_id", "toxic", "f0", "f1", "f2"],
                )

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """A network learnt from labelled documents that are not held out.

    With fewer than two rows of either class there is nothing to learn, and every score is the share of
    toxic rows, (toxic + 1) / (rows + 2). Training takes SAMPLE_WINDOWS windows of each sampled
    document, a bound of the training sample like the number of its rows; scoring reads every window."""
    sample = learning_rows(docs, labels, rows)
    counts = {(h, y): n for h, y, n in sample.groupBy("half", "toxic").count().collect()}
    if len(counts) < 4:
        positive = sum(n for (_, y), n in counts.items() if y) + 1
        share = positive / (sum(counts.values()) + 2)
        blank = Network(np.zeros((INPUTS, BUCKETS), np.float32), train(np.zeros((0, 1)), None), None)
        blank.pool = np.array([0, 0, 0, np.log(share / (1 - share))])
        return blank
    halves = [sample.where(F.col("half") == h) for h in (0, 1)]
    seen = [presence(half) for half in halves]
    totals = [(counts[h, 0.0], counts[h, 1.0]) for h in (0, 1)]
    # each half is looked at with what the other half knows
    views = [
        (halves[1 - h].select("doc_id", "toxic", "text"), Network(log_odds(seen[h], *totals[h]), {}, np.zeros(4)))
        for h in (0, 1)
    ]
    drawn = [
        rows.mapInArrow(_sample_windows(view), "doc_id bigint, toxic double, inputs binary")
        for rows, view in views
    ]
    drawn = drawn[0].union(drawn[1]).toArrow().to_pandas().sort_values(["doc_id", "inputs"])
    x = np.frombuffer(b"".join(drawn["inputs"]), np.float32).reshape(-1, WINDOW, INPUTS)
    weights = train(x, drawn["toxic"].to_numpy(np.float32))
    pooled = []
    for rows, view in views:
        view.weights = weights
        pooled.append(
            rows.mapInArrow(
                _features(view), "doc_id bigint, toxic double, f0 double, f1 double, f2 double"
            )
        )
    pooled = pooled[0].union(pooled[1]).toArrow().to_pandas().sort_values("doc_id")
    features = np.column_stack([pooled[["f0", "f1", "f2"]].to_numpy(), np.ones(len(pooled))])
    pool = fit_pool(features, pooled["toxic"].to_numpy())
    both = log_odds(seen[0] + seen[1], *[sum(n) for n in zip(*totals)])
    return Network(both, weights, pool)


def _scorer(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch.column(1)):
                ids = batch.column(0).slice(texts.first, texts.count)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(network.scores(texts))], ["doc_id", "score"]
                )

    return run


def score(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text).

    The whole text is scored; a null text counts as empty, and an empty one as a window of null
    words. A null doc_id is kept and not held out; repeated rows get equal scores. Other columns of
    docs are not read. The network is a few MB whatever the size of the corpus.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = rows.mapInArrow(_scorer(network), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, network: Network) -> DataFrame:
    """The rows of docs, all columns as they are, that score below THRESHOLD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            keep = [network.scores(texts) < THRESHOLD for texts in text_chunks(column)]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    place = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
