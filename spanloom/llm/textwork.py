"""Vectorised word and n-gram work on Arrow text columns; runs inside tasks.

Texts are taken as UTF-8 bytes. All word classes used here treat every byte of 0x80 and above alike, so words can be
cut from bytes without decoding. Work goes slice by slice, each of about a megabyte or of one longer text.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _byte_table(rule) -> np.ndarray:
    return np.array([rule(b) for b in range(256)])


#: Anything but space and the ASCII controls 0x09 to 0x0D.
NON_SPACE = _byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ASCII letters and digits, and all beyond ASCII.
ALNUM = _byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = _byte_table(lambda b: b + 32 if 0x41 <= b <= 0x5A else b).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        got = np.cumprod(up), np.cumprod(down)
        if size <= 4 * SLICE:
            _powers[base] = got
    return got


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _STEP) -> np.ndarray:
    """A hash of values[start:end] for each pair; the same values give the same hash wherever they stand."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


class Slice(NamedTuple):
    lo: int  #: rows lo to hi of the column
    hi: int
    data: np.ndarray  #: their bytes
    offsets: np.ndarray  #: where each row's bytes begin, and the end


def slices(column: pa.Array, size: int = SLICE) -> Iterator[Slice]:
    """Nulls count as empty texts."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, len(column), lo + 65536)
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


class Words(NamedTuple):
    start: np.ndarray  #: first byte in the slice
    end: np.ndarray
    first: np.ndarray  #: by row, its first word, and the number of words
    hash: np.ndarray


def words(s: Slice, table: np.ndarray, lower: bool) -> Words:
    data = LOWER[s.data] if lower else s.data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = s.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, s.offsets), rolling(data.astype(np.uint64) + np.uint64(1), start, end, _BASE))


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which k values of one row begin, and the hash of those values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return at, rolling(hashes, at, at + k)


def winnow(at: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Indexes of the smallest of each ``window`` hashes at consecutive positions; of equal ones, the first.

    What a window selects depends on its own values only, so equal stretches select alike.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = np.flatnonzero(at[window - 1 :] - at[:n] == window - 1)
    best = np.arange(len(hashes))
    low = hashes.copy()
    span = 1
    while span < window:  # doubling: low[i] is the least of span values from i on
        step = min(span, window - span)
        m = len(low) - step
        take = low[step:] < low[:m]
        best = np.where(take, best[step : step + m], best[:m])
        low = np.where(take, low[step:], low[:m])
        span += step
    return np.unique(best[whole])


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def whole_groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Cut a stream sorted by its first column into tables of about ``size`` rows that never part a group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n < size:
            continue
        t = pa.Table.from_batches(held)
        key = t.column(0).to_numpy()
        end = int(np.searchsorted(key, key[-1], "left"))
        if end:
            yield t.slice(0, end)
        held, n = t.slice(end).to_batches(), len(t) - end
    if n:
        yield pa.Table.from_batches(held)


Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(scan: Scan) -> Scan:
    """The same scan, which hands free memory back when its task ends: Spark keeps Python workers for tasks to come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)

    return run
