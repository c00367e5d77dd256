"""Whole columns of text as flat byte arrays: words, lines and their hashes without a loop per word.

Every function works on UTF-8 bytes of one piece of an Arrow batch. A piece holds
whole documents, about a megabyte of them, or one longer document.
"""

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between white space, and of words of letters and digits (bytes of 0x80 and more count as letters).
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

def give_back() -> None:
    """Hands memory that is free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches that hands memory back at its end: Spark keeps Python workers for later tasks."""

    @wraps(run)
    def and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return and_release


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (one to one)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = max(n, PIECE_BYTES + 1)
        held = np.full(size, base, dtype=np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if size <= 4 * PIECE_BYTES:  # a very long text does not stay in memory
            _POWERS[base] = held
    return held[:n]


class Hasher:
    """Hashes of any substrings of one byte array: a prefix sum of byte codes times powers."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[start:end]."""
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _STEP)


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first row, bytes, offsets) of consecutive rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, documents) of maximal runs of bytes of a class; no run crosses documents."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    is_in = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = is_in.copy()
    starts[1:] &= ~is_in[:-1] | edge[1:n]
    ends = is_in.copy()
    ends[:-1] &= ~is_in[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def per_document(documents: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(documents, weights=weights, minlength=n).astype(np.int64)


def windows(hashes: np.ndarray, documents: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first words) of runs of ``size`` words within a document."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(documents[:count] == documents[size - 1 :])
    total = np.zeros(len(first), dtype=np.uint64)
    for k in range(size):
        total = mix(total + _STEP) + hashes[first + k]
    return mix(total), first


def distinct_pairs(documents: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash), ordered by document and hash."""
    order = np.lexsort((hashes, documents))
    documents, hashes = documents[order], hashes[order]
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (documents[1:] != documents[:-1]) | (hashes[1:] != hashes[:-1])
    return documents[keep], hashes[keep]
