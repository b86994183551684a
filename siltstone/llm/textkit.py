"""Vectorised text primitives: whole Arrow batches of UTF-8 are cut into words and hashed with numpy.

A batch is handled as one byte buffer plus document offsets. No text is cut short; batches are only
split between documents so that working memory stays near ``CHUNK`` bytes (or one document, if larger).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
LONG_WORD = 256
U = np.uint64
MULT = U(0x9E3779B97F4A7C15 | 1)
MULT_INV = U(pow(int(MULT), -1, 1 << 64))
M1, M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

try:
    TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    TRIM = None

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``MULT ** i`` and its inverse modulo 2 ** 64 for i below n, grown on demand."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        for k, base in ((0, MULT), (1, MULT_INV)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> U(30))) * M1
    h = (h ^ (h >> U(27))) * M2
    return h ^ (h >> U(31))


def give_back() -> None:
    """Return memory that this process no longer uses to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def chunks(arr: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, row after the last, UTF-8 bytes, offsets of the rows) of a string column; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "") if arr.null_count else arr
    if len(arr) == 0:
        return
    if arr.type != pa.large_string():
        arr = arr.cast(pa.large_string())
    _, raw, data = arr.buffers()
    offsets = np.frombuffer(raw, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(arr):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(arr))
        yield first, last, buffer[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    give_back()


def runs(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True inside each document: starts, ends, and how many runs lie before each document."""
    n = len(keep)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n + 1, bool)
    before[0], before[1:] = False, keep
    after = np.empty(n + 1, bool)
    after[:n], after[n] = keep, False
    starts = np.flatnonzero(after & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~after))
    return starts, ends, np.searchsorted(starts, offsets)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs by differences of one prefix sum; runs over ``LONG_WORD`` bytes use blake2b."""
    n = len(data)
    if len(starts) == 0:
        return np.zeros(0, U)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=sums[1:])
    size = ends - starts
    out = mix((sums[ends] - sums[starts]) * down[starts] + size.astype(U) * M2)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and the index of each document's first word."""
    data = LOWER[data] if lower else data
    starts, ends, first = runs(~SPACE[data], offsets)
    return hash_runs(data, starts, ends), first


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each item, given where each document's items begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def salts(n: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U) * MULT) | U(1)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, sorted: (document, hash).

    A shingle is ``width`` successive words. A document with fewer words has its whole sequence as its one
    shingle; one without words has none.
    """
    k = salts(width + 1)
    count = np.diff(first)
    n = len(hashes)
    doc = owners(first)
    got_doc, got = [], []
    if n >= width:
        ok = doc[: n - width + 1] == doc[width - 1 :]
        acc = np.zeros(n - width + 1, U)
        for j in range(width):
            acc += hashes[j : n - width + 1 + j] * k[j]
        got.append(mix(acc[ok]))
        got_doc.append(doc[: n - width + 1][ok])
    for size in range(1, width):
        short = np.flatnonzero(count == size)
        if len(short):
            acc = np.full(len(short), size, U) * k[width]
            for j in range(size):
                acc += hashes[first[short] + j] * k[j]
            got.append(mix(acc))
            got_doc.append(short)
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, U)
    d, h = np.concatenate(got_doc), np.concatenate(got)
    order = np.argsort(h, kind="stable")
    d, h = d[order], h[order]
    order = np.argsort(d.astype(np.int32), kind="stable")
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, 0 for empty ones; computed segment by segment, so as exact as a plain sum."""
    n = len(first) - 1
    out = np.zeros((n,) + values.shape[1:], np.float64)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64, copy=False), first[full], axis=0)
    return out
