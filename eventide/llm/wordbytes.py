"""Vectorised words, word hashes and word n-grams over Arrow string batches.

A batch's UTF-8 bytes are handled as one numpy array: separator bytes split
words, and a word's 64-bit hash is a difference of prefix sums of a polynomial
over randomised byte values. Work per byte is a handful of array operations,
whatever the words are. Batches are cut into blocks of about a megabyte (or
one longer text), which bounds the temporary arrays.

Sums modulo 2 ** 64 tell short words apart like random numbers, but long words
can be built that share one (from 1024 bytes on by a fixed pattern), so words of
more than ``LONG`` bytes get a cryptographic hash.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):      # another C library
    _trim = None

BLOCK_BYTES = 1 << 19
LONG = 64
WHITE = bytes([0x20, *range(0x09, 0x0E)])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_RANDOM = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLOTS = np.random.Generator(np.random.PCG64(7919)).integers(
    1, 1 << 63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (each input bit reaches each output bit)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def give_back() -> None:
    """Return freed memory to the system: workers live on, and two of them share
    an executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lowered()
RAW = np.arange(256, dtype=np.uint8)


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if n == 0:
        return
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64 if wide else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(ends, ends[row] + BLOCK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, raw[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop
    give_back()


@dataclass
class Words:
    """Words of a block: ``first[d]:first[d + 1]`` are the words of row d."""

    rows: int
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))


def spans(text: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of equal, nonzero kind that stay in one row."""
    kind = kinds[text]
    n = len(kind)
    cut = np.ones(n + 1, bool)
    if n:
        cut[1:n] = kind[1:] != kind[:-1]
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    keep = kind[start] != 0 if n else np.zeros(0, bool)
    return start[keep], end[keep]


def hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray) -> np.ndarray:
    n = len(text)
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_RANDOM[fold][text] * power, out=sums[1:])
    out = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    for k in np.flatnonzero(end - start > LONG).tolist():
        out[k] = strong(fold[text[start[k]:end[k]]].tobytes())
    return out


def strong(word: bytes) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))


def words(text: np.ndarray, offsets: np.ndarray, kinds: np.ndarray,
          fold: np.ndarray = RAW) -> Words:
    """Words of a block. ``kinds[b]`` is 0 for separator bytes; runs of
    different kinds are different words; ``fold`` maps bytes before hashing."""
    start, end = spans(text, offsets, kinds)
    return Words(len(offsets) - 1, start, end, hashes(text, start, end, fold),
                 np.searchsorted(start, offsets))


def windows(w: Words, size: int, gaps: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of ``size`` words inside one row;
    with ``gaps``, of the words at these distances from the first."""
    at = gaps or tuple(range(size))
    n = len(w.hash) - at[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = w.row
    inside = np.flatnonzero(row[:n] == row[at[-1]:at[-1] + n])
    total = np.full(len(inside), np.uint64(len(at) * 1000003 + at[-1]), np.uint64)
    for slot, gap in enumerate(at):
        total += w.hash[inside + gap] * _SLOTS[slot]
    return inside, mix(total)


def whole(w: Words, row: int) -> np.uint64:
    """Hash of all words of a (short) row as one sequence."""
    part = w.hash[w.first[row]:w.first[row + 1]]
    total = np.uint64(len(part) * 1000003 + len(part) - 1)
    for slot, value in enumerate(part):
        total = np.add(total, np.multiply(value, _SLOTS[slot]))
    return mix(np.array([total], np.uint64))[0]
