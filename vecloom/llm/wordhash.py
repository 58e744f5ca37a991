"""Words and word n-grams of whole Arrow batches as 64-bit hashes, in NumPy.

Bytes of a batch are hashed by one prefix sum per base: with `P[i] = sum(byte_j * B**j)` modulo
2**64 for odd B, the hash of bytes s..e is `(P[e] - P[s]) * B**-s`, then mixed. N-grams are
hashed the same way over the hashes of their words. Cost is linear in the bytes, whatever n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
SLICE_BYTES = 1 << 18  # working arrays take about 100 times as much

#: The bytes that part words: space and \t \n \v \f \r.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i up to n at least; kept, and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(12, n.bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, U64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=U64))
        if n > 4 * SLICE_BYTES:  # one huge text: don't keep tables of its size
            return tables[0], tables[1]
        _powers[base] = have = (tables[0], tables[1])
    return have


def _prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power_table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


class Words:
    """The words of some texts: `row` (text number), `start` and `end` (bytes in `data`)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, separators: np.ndarray = SPACES):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~separators[self.data]
        edge = np.empty(len(data) + 1, bool)
        if len(data):
            edge[0] = inside[0]
            edge[-1] = False
            np.greater(inside[1:], inside[:-1], out=edge[1:-1])
            cut = offsets[(offsets > 0) & (offsets < len(data))]
            edge[cut] = inside[cut]
            self.start = np.flatnonzero(edge[:-1])
            last = np.empty(len(data), bool)
            last[-1] = inside[-1]
            np.greater(inside[:-1], inside[1:], out=last[:-1])
            last[cut - 1] = inside[cut - 1]
            self.end = np.flatnonzero(last) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        # First word of each text, and one past the last of the last text.
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, base: int = 0) -> np.ndarray:
        sums, down = _prefix(self.data.astype(U64) + U64(1), BASES[base])
        return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def ngrams(hashes: np.ndarray, n: int, base: int = 0) -> np.ndarray:
    """Hash of the n words from each place on, across texts; `whole` tells which places count."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    sums, down = _prefix(hashes, BASES[base])
    places = len(hashes) - n + 1
    return mix((sums[n:] - sums[:places]) * down[:places])


def whole(words: Words, n: int) -> np.ndarray:
    """Which places of `ngrams` lie in one text."""
    places = len(words.row) - n + 1
    return words.row[n - 1 :] == words.row[:places] if places > 0 else np.zeros(0, bool)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; NULL reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array, lower: bool, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) of runs of texts of about `size` bytes at most.

    Texts are never cut: one longer than `size` makes a slice of its own.
    """
    data, offsets = text_buffers(column)
    n, low = len(offsets) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield low, high, Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lower)
        low = high
