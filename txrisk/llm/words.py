"""Words and shingles of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and 0x09 to 0x0D. Nothing here makes a Python object for
a word: positions, hashes and shingles are numpy arrays over the bytes of a chunk of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Whole texts are worked on in chunks of about this many bytes; a longer text is a chunk alone.
CHUNK_BYTES = 1 << 19

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Texts:
    """A chunk of whole texts: their bytes, one after the other, and where each begins."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> int:
        return len(self.bounds) - 1


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Chunks of a text column; a null counts as an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        begin, end = int(bounds[first]), int(bounds[last])
        yield Texts(first, data[begin:end], bounds[first : last + 1] - begin)
        first = last


@dataclass
class Words:
    """Words of a chunk in order: byte range, text they are in, and a 64-bit hash of the bytes."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    #: words before each text, and of all texts at the end
    bounds: np.ndarray


def find_words(texts: Texts, lower: bool = True) -> Words:
    """lower: A-Z count as a-z in the hash."""
    inside = ~_SEPARATOR[texts.data]
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    edges = texts.bounds[:-1][texts.bounds[:-1] < len(inside)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(texts.bounds, starts, side="right") - 1
    up, down = _POWERS.upto(len(inside) + 1)
    sums = np.zeros(len(inside) + 1, dtype=np.uint64)
    np.cumsum((_LOWER_CODES if lower else _CODES)[texts.data] * up[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.searchsorted(text, np.arange(texts.count + 1))
    return Words(starts, ends, text, hashes, bounds)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range. Equal bytes have equal hashes; bytes made to collide
    may have them too, so whoever needs to be sure compares."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def fold(parts: list[np.ndarray], length: int) -> np.ndarray:
    """One hash for each sequence of words, given the hashes of its first, second ... words."""
    out = mix(parts[0] + U64(length))
    for part in parts[1:]:
        out = mix(out * U64(_BASE) + part)
    return out


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles with their texts, in order; a text of fewer words is one."""
    n = len(words.hashes)
    hashes, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if n >= k:
        whole = words.text[: n - k + 1] == words.text[k - 1 :]
        parts = [words.hashes[j : n - k + 1 + j][whole] for j in range(k)]
        hashes.append(fold(parts, k))
        texts.append(words.text[: n - k + 1][whole])
    counts = np.diff(words.bounds)
    for length in range(1, k):
        few = np.flatnonzero(counts == length)
        if len(few):
            at = words.bounds[few]
            hashes.append(fold([words.hashes[at + j] for j in range(length)], length))
            texts.append(few)
    hashes, texts = np.concatenate(hashes), np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return hashes[order], texts[order]


def shingle_sets(texts: Texts, k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of each text, ascending."""
    hashes, text = shingles(find_words(texts), k)
    bounds = np.searchsorted(text, np.arange(texts.count + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
