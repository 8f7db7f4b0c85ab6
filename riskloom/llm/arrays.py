"""Whole texts as numpy arrays: words, hashes of spans, content-defined anchors.

Everything here works on a slice of an Arrow batch: some consecutive texts laid end to end. A slice
holds about ``SLICE_BYTES``; one text is never cut, so a longer text is a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: An id that is null sorts after every other.
NULL_ID = (1 << 63) - 1


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield ``(first, last, data, bounds)``: UTF-8 bytes of rows [first, last), and where each begins.

    A null counts as an empty text.
    """
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, (_, offsets, data) = (np.int64 if wide else np.int32), column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(data, bounds, gaps=SPACES):
    """Starts, ends and text numbers of the maximal runs of bytes not in ``gaps``."""
    inside = ~gaps[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(bounds, starts, side="right") - 1


def mix(x):
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lane:
    """One 64-bit polynomial hash; two lanes give 128 bits."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 8 + 3 & (1 << 64) - 1
        self.powers, self.inverse = self._table(self.base, 1), self._table(pow(self.base, -1, 1 << 64), 1)

    @staticmethod
    def _table(base, n):
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    def _room(self, n):
        if len(self.powers) <= n:
            size = max(n, 1 << 18)
            self.powers = self._table(self.base, size)
            self.inverse = self._table(pow(self.base, -1, 1 << 64), size)

    def sums(self, values):
        """Prefix sums from which :meth:`span` takes the hash of any run of ``values``."""
        self._room(len(values))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def span(self, sums, start, end):
        return mix((sums[end] - sums[start]) * self.inverse[start])

    def words(self, data, starts, ends):
        """A hash of each word."""
        return self.span(self.sums(self.bytes[data]), starts, ends) + (ends - starts).astype(np.uint64)


FIRST, SECOND = Lane(11), Lane(23)


def sliding(best, values, width):
    """``best`` of each ``width`` consecutive values."""
    size, out = 1, values
    if len(values) < width:
        return values[:0]
    while size * 2 <= width:
        out, size = best(out[:-size], out[size:]), size * 2
    rest = width - size
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(values, owner, width, reach):
    """Positions of the values that are the least of some ``width`` consecutive ones.

    ``owner[i]`` is the text of position i and ``reach`` how many units one value covers; a window
    that spans two texts counts for nothing. Equal windows of ``width + reach - 1`` units thus hold
    the same anchor at the same place.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    values = values | np.uint64(1)
    least = sliding(np.minimum, values, width)
    units = width + reach - 1
    whole = np.zeros(n, dtype=bool)
    fits = max(0, len(owner) - units + 1)
    whole[:fits] = (owner[:fits] == owner[units - 1 :])[:n]
    least = np.where(whole, least, np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.maximum, np.concatenate([pad, least, pad]), width) == values)


def covered(n, starts, lengths):
    """Which of n positions lie in a span."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def signed(x):
    """Hashes as Spark's long."""
    return x.view(np.int64)
