"""Words, lines and windows of many documents at once, on the byte buffers that Arrow hands over.

Words are maximal runs of bytes other than space and 0x09-0x0D. In UTF-8 these six never occur inside another character,
so bytes and characters agree. Hashes are 64-bit; equal spans have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: each input bit reaches each output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: One random value for each byte.
BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64; kept in the worker, grown by doubling."""
    if len(_powers.get(base, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        grown = np.full(size, base, U64)
        grown[0] = 1
        _powers[base] = np.multiply.accumulate(grown)
    return _powers[base]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def blocks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `size` bytes: first row, row after the last, bytes, starts of the rows."""
    if not len(column):
        return
    data, starts = flat(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a row: their first byte and the byte after their last."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: first byte, byte after the last, row."""
    begin, end = runs(~WHITE[data], starts)
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which `spans` takes the hash of any span."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE[data] * powers(_INVERSE, len(data))[: len(data)], out=out[1:])
    return out


def spans(running: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [begin, end)."""
    value = (running[end] - running[begin]) * powers(_BASE, len(running))[begin]
    return mix(value + (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n neighbouring hashes; those that cross a row are the caller's to leave out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = hashes[:count].copy()
    for i in range(1, n):
        total *= U64(0xA0761D6478BD642F)
        total += hashes[i : i + count]
    return mix(total)


def in_row(row: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n neighbouring words lie in one row."""
    count = len(row) - n + 1
    return row[:count] == row[n - 1 :] if count > 0 else np.zeros(0, bool)
