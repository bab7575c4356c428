"""Array helpers for whole batches of texts; used inside mapInArrow tasks.

Words are compared by 64-bit hashes computed for all bytes of a chunk of texts at once.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache, wraps
from inspect import signature

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_CODE[65:91] = _BYTE_CODE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space and ASCII signs: for words without their punctuation.
SIGNS = _SPACE.copy()
SIGNS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
#: Codes under which accented Latin capitals count as small letters too (other letters may meet).
FOLDED = _BYTE_CODE.copy()
FOLDED[0x80:0x9F] = FOLDED[0xA0:0xBF]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
CHUNK_BYTES = 1_000_000
#: Powers that a worker keeps, of the base and of its inverse: 2 MB each.
KEPT_POWERS = 1 << 18


def release() -> None:
    """Gives memory that is no longer used back to the machine; workers live on after a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, which turns the batches of a task into others, with ``release`` at its end."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def tidy_group(run: Callable) -> Callable:
    """``run``, which works on one bounded group (or a key and a group) at a time, with ``release`` behind each."""

    def done(*args):
        try:
            return run(*args)
        finally:
            release()

    # Spark counts the parameters
    return (lambda rows: done(rows)) if len(signature(run).parameters) == 1 else (lambda first, second: done(first, second))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over a 64-bit value."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _raised(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_kept_powers = cache(_raised)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return _kept_powers(base, KEPT_POWERS)[:n] if n <= KEPT_POWERS else _raised(base, n)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of at most ``limit`` bytes; a null is empty.

    A text is never cut: a longer one makes a chunk of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        part = offsets[first : end + 1]
        yield first, end, data[part[0] : part[-1]], part - part[0]
        first = end


def words(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE, codes: np.ndarray = _BYTE_CODE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes (A-Z lower-cased, split at ASCII white space or other ``breaks``) of a chunk.

    Returns (hashes, starts, ends, counts): byte spans of the words, and words per text.
    """
    inside = ~breaks[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    cut = offsets[1:][(offsets[1:] > 0) & (offsets[1:] <= len(data))] - 1
    after[cut] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    weighted = codes[data]
    weighted *= _powers(_BASE, len(data))
    np.cumsum(weighted, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts])
    hashes ^= (ends - starts).astype(np.uint64) << np.uint64(48)
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return mix(hashes), starts, ends, counts


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; shorter input gives no run."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out *= _BASE
        out += hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def by_text(values: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Split a flat array into the parts of each text."""
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends, strict=True):
        yield values[a:b]
