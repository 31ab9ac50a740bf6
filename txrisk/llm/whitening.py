"""Embedding whitening by a Chebyshev-filtered subspace iteration.

Vectors become exact integers once, in blocks of rows on shared storage. Their covariance V is never
formed: every step is one pass over the blocks that adds up X'(XQ)/n of the centred rows X for a
narrow Q of `dimensions x columns`, the only thing the driver holds. A polynomial of V by its
three-term recurrence damps the part of the spectrum that is not wanted, a QR step and a
Rayleigh-Ritz step turn the block into approximate eigenvectors, and rounds go on until the residual
of every wanted one is at the level of rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

COMPONENTS = 32
#: Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors in a block, and values a worker works on at once.
BLOCK_VALUES = 1 << 18
#: Columns of the block beyond the wanted ones, and the highest degree of the polynomial.
GUARD, DEGREE = 16, 12
#: A pair counts as found when its residual is below this part of the largest eigenvalue.
TOLERANCE = 2e-14
#: Rounds without progress after which rounding is taken to be the limit, if the residual is below this.
ROUNDING = 1e-11
#: How much more than the least a wanted direction may grow in one polynomial; keeps QR accurate.
GROWTH = 1e7
#: Eigenvalues below this part of the largest are zero up to rounding.
NULL_SPACE = 1e-12

_LONG = 1 << 62


def _integers(vectors: pa.Array) -> np.ndarray:
    """Rows of floor(64 c) + 1,000,000 of a list column without nulls."""
    values = np.asarray(vectors.flatten().cast(pa.float64()), dtype=np.float64)
    width = len(values) // len(vectors)
    if len(values) != width * len(vectors) or (np.diff(vectors.offsets.to_numpy()) != width).any():
        raise ValueError("vectors of different lengths have no common covariance")
    scaled = np.floor(SCALE * values)
    if len(scaled) and np.abs(scaled).max() >= _LONG:
        raise OverflowError("an entry is too large for a 64-bit integer")
    return (scaled.astype(np.int64) + SHIFT).reshape(len(vectors), width)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = _integers(batch.column(1))
        rows = max(1, BLOCK_VALUES // max(1, x.shape[1]))
        for first in range(0, len(x), rows):
            part = x[first : first + rows]
            ids = batch.column(0).slice(first, rows)
            bounds = pa.array([0, len(ids)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.shape[1]], pa.int32()),
                    pa.ListArray.from_arrays(bounds, ids),
                    pa.array([part.tobytes()], pa.binary()),
                ],
                ["width", "ids", "x"],
            )


def to_blocks(embeddings: DataFrame) -> DataFrame:
    """(width, ids, x): integer rows of the vectors that count, many in a block.

    Vectors that are null, empty, or hold null or non-finite entries are left out; the filter is a
    Spark expression. Written once; everything after reads the blocks.
    """
    finite = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    rows = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    blocks = rows.select("vec_id", "embedding").mapInArrow(
        _to_blocks, f"width int, ids array<{kind}>, x binary"
    )
    return stored(blocks, "whitening-blocks")


@dataclass(frozen=True)
class Fit:
    """What centring needs: vectors, and exact sums by dimension."""

    n: int
    sums: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def spread(self, x: bytes) -> np.ndarray:
        """n*x - S of a block, exact."""
        rows = np.frombuffer(x, dtype=np.int64).reshape(-1, self.width)
        if len(rows) and self.n * max(int(rows.max()), -int(rows.min())) >= _LONG:
            raise OverflowError("n*x is too large for a 64-bit integer")
        return self.n * rows - self.sums

    def centred(self, x: bytes) -> np.ndarray:
        return self.spread(x) / self.n


def _summed(blocks: DataFrame, one: Callable[[bytes], np.ndarray], shape: tuple[int, int], kind="double"):
    """The sum over all blocks of a matrix that `one` makes of each.

    A task adds up its blocks and gives one row for each row of the matrix; Spark adds those up by row
    number, so neither a task nor the driver sees more than a bound that the matrix sets.
    """
    rows, columns = shape
    number = np.float64 if kind == "double" else np.int64
    names = [f"c{j}" for j in range(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0):
                part = one(x.as_py())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(rows), pa.int32()), *[pa.array(total[:, j]) for j in range(columns)]],
                ["i", *names],
            )

    parts = blocks.select("x").mapInArrow(run, ", ".join(["i int", *[f"{c} {kind}" for c in names]]))
    out = np.zeros(shape, dtype=number)
    for row in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row["i"]] = row[1:]
    return out


def fit(blocks: DataFrame) -> Fit | None:
    """Counts and sums of all blocks; None without a vector."""
    found = blocks.agg(F.min("width"), F.max("width"), F.sum(F.size("ids"))).first()
    low, high, n = found
    if not n:
        return None
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} entries have no common covariance")

    def sums(x: bytes) -> np.ndarray:
        return np.frombuffer(x, dtype=np.int64).reshape(-1, low).sum(axis=0)[:, None]

    return Fit(n, _summed(blocks, sums, (low, 1), "bigint")[:, 0])


def gram_pass(blocks: DataFrame, fitted: Fit, q: np.ndarray) -> np.ndarray:
    """V q = X'(X q)/n over the centred rows X: one pass over the blocks."""

    def one(x: bytes) -> np.ndarray:
        rows = fitted.centred(x)
        return rows.T @ (rows @ q)

    return _summed(blocks, one, q.shape) / fitted.n


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues, their unit vectors as columns, and how it went."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def _filter(apply, q, found, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times q: at most 1 on [low, cut], growing above, scaled at `top`.

    `found` are unit vectors already settled; they are taken out at every step, or the largest of
    them would swamp all others.
    """

    def out(y):
        return y - found @ (found.T @ y)

    half, middle = (cut - low) / 2, (cut + low) / 2
    scale = first = half / (top - middle)
    before, now = q, out(apply(q) - middle * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        after = out(apply(now) - middle * now) * (2 * following / half) - scale * following * before
        before, now, scale = now, after, following
    return now


def _lowest(apply, width: int, rng, steps: int = 12) -> float:
    """A guess from below at the least eigenvalue, by a short Lanczos run."""
    basis = [_unit(rng.standard_normal(width))]
    diagonal, beside = [], []
    for _ in range(min(steps, width)):
        w = apply(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ w)
        for b in (*basis, *basis):
            w = w - b * (b @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        basis.append(w / beside[-1])
    n = len(diagonal)
    small = np.diag(diagonal) + np.diag(beside[: n - 1], 1) + np.diag(beside[: n - 1], -1)
    values, vectors = np.linalg.eigh(small)
    return max(0.0, float(values[0] - beside[n - 1] * abs(vectors[-1, 0])))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x)


def leading(apply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS) -> Spectrum:
    """The `wanted` largest eigenpairs of the symmetric matrix that `apply` multiplies by.

    Rounds of filter, QR and Rayleigh-Ritz. The cut of the filter is the least Ritz value of the
    block; pairs at rounding level are settled and the filter works on the rest. If a run of equal
    eigenvalues is wider than the block, no filter can part it: the block grows, up to all
    dimensions, where Rayleigh-Ritz alone is exact.
    """
    rng, passes = np.random.default_rng(20240229), 0

    def counted(y):
        nonlocal passes
        passes += 1
        return apply(y)

    wanted = min(wanted, width)
    size = min(width, wanted + GUARD)
    q = np.linalg.qr(rng.standard_normal((width, size)))[0]
    low = _lowest(counted, width, rng) if size < width else 0.0
    best, idle = np.inf, 0
    while True:
        w = counted(q)
        small = q.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        residuals = np.linalg.norm(w - q * values, axis=0) / max(values[0], np.finfo(float).tiny)
        worst = float(residuals[:wanted].max())
        idle = idle + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if size == width or worst <= TOLERANCE or (idle >= 2 and worst <= ROUNDING):
            return Spectrum(values[:wanted], q[:, :wanted], worst, passes)
        if idle >= 4:
            more = rng.standard_normal((width, min(width - size, size)))
            q = np.linalg.qr(np.concatenate([q, more], axis=1))[0]
            size, best, idle = q.shape[1], np.inf, 0
            continue
        settled = int(np.argmax(np.append(residuals[:wanted], np.inf) > TOLERANCE))
        low = min(low, float(values[-1]))
        cut = float(values[-1])
        low = min(low, cut - 1e-3 * abs(cut))
        top = float(max(values[settled], cut + 1e-9 * abs(values[0])))
        steepness = np.arccosh(max(1.0 + 1e-12, (2 * top - cut - low) / (cut - low)))
        degree = int(np.clip(np.arccosh(GROWTH) / steepness, 1, DEGREE))
        fixed = q[:, :settled]
        grown = _filter(counted, q[:, settled:], fixed, low, cut, top, degree)
        grown -= fixed @ (fixed.T @ grown)
        q = np.concatenate([fixed, np.linalg.qr(grown)[0]], axis=1)


@dataclass(frozen=True)
class Whitening:
    """The fitted map: centring, components as columns, eigenvalues, and figures about them."""

    fitted: Fit
    spectrum: Spectrum
    trace: float
    identity_error: float

    def map(self, x: bytes) -> np.ndarray:
        return self.fitted.centred(x) @ (self.spectrum.vectors / np.sqrt(self.spectrum.values))


def fit_whitening(blocks: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """Fitted on every vector of the blocks; None without one.

    Components whose eigenvalue is zero up to rounding have no whitened coordinate and are left out.
    """
    fitted = fit(blocks)
    if fitted is None:
        return None
    trace = float(_summed(blocks, lambda x: np.square(fitted.centred(x)).sum(keepdims=True), (1, 1))[0, 0])
    trace /= fitted.n
    found = leading(lambda q: gram_pass(blocks, fitted, q), fitted.width, wanted)
    real = found.values > NULL_SPACE * max(found.values[0], 0.0)
    found = Spectrum(found.values[real], found.vectors[:, real], found.residual, found.passes)
    k = len(found.values)
    if k == 0:
        return Whitening(fitted, found, trace, 0.0)
    plain = Whitening(fitted, found, trace, 0.0)
    mean = _summed(blocks, lambda x: plain.map(x).sum(axis=0, keepdims=True), (1, k)) / fitted.n

    def products(x: bytes) -> np.ndarray:
        rows = plain.map(x) - mean
        return rows.T @ rows

    error = np.abs(_summed(blocks, products, (k, k)) / fitted.n - np.eye(k)).max()
    return Whitening(fitted, found, trace, float(error))


_ROWS = 256


def whitened(blocks: DataFrame, whitening: Whitening | None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of all blocks."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    if whitening is None or len(whitening.spectrum.values) == 0:
        return blocks.sparkSession.createDataFrame([], schema)
    fitted, values = whitening.fitted, whitening.spectrum.values
    k, explained = len(values), values / whitening.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column(0), batch.column(1)):
                x = x.as_py()
                spread, mapped = fitted.spread(x), whitening.map(x)
                if len(spread) and float(np.abs(spread).max()) ** 2 * fitted.width >= _LONG:
                    raise OverflowError("a deviation is too large for a 64-bit integer")
                deviation = np.square(spread).sum(axis=1)
                for first in range(0, len(mapped), _ROWS):
                    part = slice(first, first + _ROWS)
                    rows = len(mapped[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.values.slice(first, rows).take(pa.array(np.repeat(np.arange(rows), k))),
                            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                            pa.array(np.full(rows * k, fitted.n)),
                            pa.array(np.repeat(deviation[part], k)),
                            pa.array(mapped[part].ravel()),
                            pa.array(np.tile(explained, rows)),
                            pa.array(np.full(rows * k, whitening.identity_error)),
                        ],
                        [c.split()[0] for c in schema.split(", ")],
                    )

    return blocks.select("ids", "x").mapInArrow(run, schema)


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of embeddings (vec_id, embedding), one row a vector and component.

    Vectors that are null, empty or hold a null, NaN or infinite entry give no row. A null or repeated
    vec_id is kept as it is, each row for itself. Equal vectors count as often as they occur.
    Components are numbered by falling eigenvalue; among equal eigenvalues any orthonormal choice is
    right. Where all vectors are equal no direction has a variance and there is no row, as for an
    empty table; with fewer dimensions than `wanted` there are as many components as dimensions
    with a variance. Vectors of different lengths are an error, and so is a vector whose exact
    integers do not fit 64 bits. Other columns are not read.
    """
    blocks = to_blocks(embeddings)
    return whitened(blocks, fit_whitening(blocks, wanted))
