"""Vectorised tokenising of Arrow string columns.

A column's UTF-8 bytes are cut into words with array arithmetic only; texts are
never decoded one by one. All work arrays are bounded by ``CHUNK`` bytes of text
or by the longest single word, whichever is larger.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))

#: bytes of a word: anything but space, tab, LF, VT, FF, CR
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: bytes of a word after A-Z were lower-cased: digits, a-z, every non-ASCII byte
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string/binary column and the n+1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(raw: np.ndarray, bounds: np.ndarray, inside_table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first
    word (n+1 entries). A word never crosses a text boundary."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = inside_table[raw]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(raw)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = before
    after[-1], after[:-1] = False, inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA5A5A5A5C3C3C3C3)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_P, _P_INV):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        both.append(np.cumprod(x, dtype=np.uint64))
    return both[0], both[1]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums of a polynomial hash."""
    out = np.empty(len(starts), np.uint64)
    up = down = None
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
        n = int(ends[j - 1]) - base
        if up is None or len(up) < n + 1:
            up, down = _powers(max(n + 1, min(CHUNK, len(raw)) + 1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[base:base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n hashes starting at each place (len - n + 1 entries),
    built by doubling; a length between powers of two overlaps two halves."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    size, level = 1, hashes
    while size * 2 <= n:
        level = pair(level[:-size], level[size:])
        size *= 2
    if size < n:
        level = pair(level[:len(level) - (n - size)], level[n - size:])
    return level


def per_text(first: np.ndarray) -> np.ndarray:
    """The text index of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def chunks(bounds: np.ndarray, most: int):
    """Ranges of texts of at most ``most`` bytes together (one text at least)."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def given_back(run: Callable) -> Callable:
    """A worker function that returns what it no longer uses to the system when
    its partition ends: workers are used again, and would keep their largest
    step's memory."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
            if trim is not None:
                trim(0)

    return wrapped
