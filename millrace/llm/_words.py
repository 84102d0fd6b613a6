"""Words of Arrow string columns as numpy arrays of 64-bit hashes, a slice of a few MB at a time.

A word hash is a polynomial of its bytes modulo 2**64 with random byte values, mixed with its length. Two
different words share one with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_RANDOM = np.random.default_rng(0x5EED)
_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def folded(values: np.ndarray) -> np.ndarray:
    """The byte table with A-Z standing for a-z."""
    out = values.copy()
    out[65:91] = out[97:123]
    return out


_FOLDED = folded(_VALUES)
#: Byte values for words as they are, upper and lower case apart; and others, for hashes that have nothing to do with the first.
AS_IS = _VALUES
AS_IS_TOO = np.random.default_rng(0x2EED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _letters() -> np.ndarray:
    """Separators of letter words: every ASCII byte that is no letter."""
    seps = np.ones(256, bool)
    seps[65:91] = seps[97:123] = seps[128:] = False
    return seps


SPACES, NON_LETTERS = _SPACES, _letters()


class _Powers:
    """Powers of an odd number modulo 2**64, kept as long as the longest slice so far."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, SLICE_BYTES + 65536), self.base, np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, so that any bits of a hash may be used."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Slice:
    """Some rows: their text bytes end to end, and where each text begins (one more offset than rows)."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, most_rows: int = 1 << 16) -> Iterator[Slice]:
    """Runs of at most ``most_rows`` rows and ``limit`` bytes, or one longer row. NULL texts have no bytes."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    first = 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_string()).fill_null("")
        if not len(chunk):
            continue
        _, offset_buffer, data_buffer = chunk.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(chunk):
            end = min(max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1), row + most_rows)
            yield Slice(first + row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
            row = end
        first += len(chunk)


@dataclass
class Words:
    """The words of a slice: row, hash and byte span of each, in text order."""

    row: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # words of row r: bounds[r] to bounds[r + 1]


def words_of(part: Slice, separators: np.ndarray = SPACES, values: np.ndarray = _FOLDED) -> Words:
    data, n = part.data, len(part.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none.astype(np.uint64), none, none, np.zeros(part.rows + 1, np.int64))
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[part.offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _UP.upto(n), out=sums[1:])
    hashes = (sums[end] - sums[start]) * _DOWN.upto(n)[start]
    hashes = mix(hashes ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    bounds = np.searchsorted(start, part.offsets)
    row = np.repeat(np.arange(part.rows), np.diff(bounds))
    return Words(row, hashes, start, end, bounds)


def windows_of(words: Words, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words from each place on, across rows too; as many fewer as the last ``width - 1`` places."""
    n = max(0, len(words.hash) - width + 1)
    sums = np.zeros(len(words.hash) + 1, np.uint64)
    np.cumsum(words.hash * _UP.upto(len(words.hash)), out=sums[1:])
    return mix((sums[len(sums) - n :] - sums[:n]) * _DOWN.upto(n))


def least_of_run(values: np.ndarray, run: int) -> np.ndarray:
    """The smallest of the ``run`` values from each place on."""
    low, size = values, 1
    while 2 * size <= run:
        low, size = np.minimum(low[: len(low) - size], low[size:]), 2 * size
    return np.minimum(low[: len(low) - (run - size)], low[run - size :]) if len(low) else low


def shingles_of(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in text order, and the bounds of each row's.

    A text of fewer words than ``width`` has its whole sequence as one shingle, a text without words none.
    """
    h, n = words.hash, np.diff(words.bounds)
    factors = _UP.upto(width + 2)[1:]
    total = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        total += h[k : k + len(total)] * factors[k]
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(bounds[-1], np.uint64)
    long_rows = np.flatnonzero(n >= width)
    where = np.repeat(words.bounds[long_rows] - bounds[long_rows], counts[long_rows])
    at = np.repeat(n >= width, counts)
    out[at] = total[np.flatnonzero(at) + where]
    for r in np.flatnonzero((n > 0) & (n < width)):
        own = h[words.bounds[r] : words.bounds[r + 1]]
        out[bounds[r]] = (own * factors[: len(own)]).sum(dtype=np.uint64) ^ np.uint64(len(own) * 0x9E3779B97F4A7C1 % 2**64)
    return mix(out), bounds
