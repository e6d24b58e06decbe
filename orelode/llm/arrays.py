"""Numpy views of Arrow text columns, for the operators that work on batches inside tasks.

Everything here handles one batch at a time, in blocks of bounded size, so a task's
memory depends on the longest text and not on the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; a null text is empty."""
    if column.type == pa.null():
        column = pa.nulls(len(column), pa.string())
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    _, where, content = column.buffers()
    if where is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if content is None or not content.size:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(rows, max(stop, row + 1))
        yield row, stop
        row = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's multiplier, and of its inverse, modulo 2**64."""
    if _powers.get("n", 0) < n:
        n = max(n, BLOCK_BYTES + 4096)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def prefix_hashes(data: np.ndarray, values: np.ndarray = _BYTE_VALUES) -> np.ndarray:
    """Sums from which ``span_hashes`` reads the hash of any stretch of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each stretch, equal wherever the bytes are."""
    down = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """What counts as a word: which bytes belong to words, and which of them are alike."""

    def __init__(self, inside: np.ndarray, alike: np.ndarray = _LOWER):
        self.inside, self.values = inside, _BYTE_VALUES[alike]

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash per word, and the number of words before each text (one more entry than texts)."""
        found, counts = [], []
        for start, stop in self._cuts(data, offsets):
            part = data[start:stop]
            edge = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop)] - start
            solid = self.inside[part]
            first, last = solid.copy(), solid.copy()
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            edge = edge[edge < len(part)]
            first[edge] = solid[edge]
            edge = edge[edge > 0] - 1
            last[edge] = solid[edge]
            begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            found.append(span_hashes(prefix_hashes(part, self.values), begin, end))
            counts.append(begin + start)
        if not found:
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        return np.concatenate(found), np.searchsorted(np.concatenate(counts), offsets)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Blocks that end at a text's end or between words, whatever the length of a text."""
        start = 0
        while start < len(data):
            stop, reach = start + BLOCK_BYTES, BLOCK_BYTES
            while stop < len(data):
                gaps = np.flatnonzero(~self.inside[data[stop : stop + reach]])
                after = int(np.searchsorted(offsets, stop))
                edge = int(offsets[after]) if after < len(offsets) else len(data)
                gap = stop + int(gaps[0]) if len(gaps) else stop + reach
                if min(gap, edge) < stop + reach or stop + reach >= len(data):
                    stop = min(gap, edge, len(data))
                    break
                stop += reach
            stop = min(stop, len(data))
            yield start, stop
            start = stop


#: Words parted by white space, ASCII letters alike in either case.
SPACED = Words(~_WHITE)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * np.uint64(_MULTIPLIER) + words[i : n + i]
        h ^= h >> np.uint64(29)
    return mix(h + np.uint64(size))
