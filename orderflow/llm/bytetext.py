"""Whole Arrow batches of text as arrays of bytes: words, lines and character runs without a loop.

Everything works on the UTF-8 bytes of many texts at once. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on together; several arrays of eight bytes per byte are alive at a time.
SLICE_BYTES = 1 << 19

_U = np.uint64
# The finaliser of splitmix64 and an odd base with its inverse modulo 2^64.
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Separators of words are the blank and bytes 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters and digits of ASCII and every byte of other scripts; all else separates.
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: A-Z to a-z; one is added so that no byte counts as zero.
_LOWER = np.arange(256, dtype=_U)
_LOWER[65:91] += _U(32)
_LOWER += _U(1)
_PLAIN = np.arange(1, 257, dtype=_U)

_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            run = np.full(n + 1, base, _U)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every bit depends on every other."""
    x = x ^ (x >> _U(30))
    x *= _MIX[0]
    x ^= x >> _U(27)
    x *= _MIX[1]
    x ^= x >> _U(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd multipliers."""
    start = np.arange(1, n + 1, dtype=_U) + _U(seed * 1_000_003)
    return mix(start * _U(_BASE)) | _U(1)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body, at.astype(np.int64)


def slices(at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    low, n = 0, len(at) - 1
    while low < n:
        high = int(np.searchsorted(at, at[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


class Hasher:
    """Hashes of any runs of bytes in one slice, from running sums."""

    def __init__(self, data: np.ndarray, fold: bool = True):
        power, self.inverse = powers(len(data))
        sums = np.empty(len(data) + 1, _U)
        sums[0] = 0
        np.cumsum((_LOWER if fold else _PLAIN)[data] * power[: len(data)], out=sums[1:])
        self.sums = sums

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One well-mixed hash per run [start, end), with its length taken in."""
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(_U))

    def runs(self, at: np.ndarray, width: int) -> np.ndarray:
        """What `of` gives for the runs [at[k], at[k + width]) of all k, without a look-up per run."""
        sums = self.sums[at]
        value = sums[width:] - sums[:-width]
        value *= self.inverse[at[:-width]]
        value += (at[width:] - at[:-width]).astype(_U)
        return mix(value)


def words(
    data: np.ndarray, at: np.ndarray, letters: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a slice, and how many words lie before each row's start.

    `at` are the row offsets within `data`. A word ends at a separator or at the end of its row;
    with `letters`, marks separate too.
    """
    letter = ~(_NO_LETTER if letters else _SPACE)[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = letter
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    start = letter & (~before[:-1] | edge[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[: len(data)] = letter
    end = before[1:] & (~after[1:] | edge[1:])
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, at)


def repeat_index(counts: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each row, one after another."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(first, counts)
