"""Words and word shingles of whole Arrow text columns as NumPy arrays.

A word is a longest run of bytes outside 0x09-0x0D and 0x20. Its hash
is a polynomial over its bytes modulo 2^64, read off running sums of
the column's bytes, so that no loop runs over rows or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at a time: the arrays below stay small for any column.
BLOCK_BYTES = 1 << 20
#: Odd factor of the polynomial and of the shingle hash.
_FACTOR = 0x9E3779B97F4A7C15 | 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
#: Bits of a lookup's first table, less one.
_TABLE = (1 << 20) - 1
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (splitmix64's last steps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_FACTOR^k and its inverse for k < n, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_FACTOR, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n, f, np.uint64)], dtype=np.uint64)
                      for f in (_FACTOR, inverse)]
    return _POWERS[0], _POWERS[1]


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's start in them (one
    more entry than rows); null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]


def row_slices(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``limit`` bytes, one row at least."""
    starts = column_bytes(texts)[1]
    at, rows = 0, len(starts) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        yield at, min(end, rows)
        at = min(end, rows)


def blocks(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bytes of which none cuts a word."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + BLOCK_BYTES, n)
        if end < n:
            rows = starts[np.searchsorted(starts, end, "right") - 1]
            gaps = np.flatnonzero(_SEPARATOR[data[at:end]])
            cut = max(rows, at + gaps[-1] + 1 if len(gaps) else at)
            if cut <= at:  # one word fills the block: go to its end
                later = np.flatnonzero(_SEPARATOR[data[end:]])
                cut = min(end + later[0] if len(later) else n, starts[np.searchsorted(starts, end, "right")])
            end = int(cut)
        yield at, end
        at = end


def word_bounds(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a block; ``row_starts`` are the
    rows that begin inside it."""
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[row_starts] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def trimmed(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without ASCII marks and digits at their ends; a word of
    nothing else becomes empty."""
    keeps = np.flatnonzero(_LETTER[data])
    if not len(keeps):
        return first, first
    a = np.searchsorted(keeps, first)
    b = np.searchsorted(keeps, last)
    some = b > a
    start = np.where(some, keeps[np.minimum(a, len(keeps) - 1)], first)
    end = np.where(some, keeps[b - 1] + 1, first)
    return start, end


class Ranges:
    """Hashes of byte ranges of a block, from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        powers, self.inverses = _powers(max(len(data), BLOCK_BYTES))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each range, unmixed."""
        return (self.sums[ends] - self.sums[starts]) * self.inverses[starts]


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and where each row's begin."""
    (hashes,), rows = word_views(texts, (), lower)
    return hashes, rows


def word_views(texts: pa.Array, affixes: tuple[int, ...], lower: bool = True,
               letters: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words, then for each number in ``affixes`` of their
    first (or, if negative, last) so many bytes, 0 for words that are
    not longer; and where each row's words begin. With ``letters``
    words lose ASCII marks and digits at both ends."""
    data, starts = column_bytes(texts)
    hashes, places = [], []
    for at, end in blocks(data, starts):
        block = data[at:end]
        inner = starts[np.searchsorted(starts, at):np.searchsorted(starts, end)] - at
        first, last = word_bounds(block, inner)
        places.append(first + at)
        if letters:
            first, last = trimmed(block, first, last)
        ranges = Ranges(LOWER[block] if lower else block)
        views = [mix(ranges.hashes(first, last))]
        for size in affixes:
            a, b = (first, np.minimum(first + size, last)) if size > 0 else (np.maximum(last + size, first), last)
            views.append(np.where(last - first > abs(size), mix(ranges.hashes(a, b) + np.uint64(size % 256)), 0))
        hashes.append(views)
    if not hashes:
        return [np.zeros(0, np.uint64)] * (1 + len(affixes)), np.zeros(len(starts), np.int64)
    return ([np.concatenate(v) for v in zip(*hashes, strict=True)],
            np.searchsorted(np.concatenate(places), starts))


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a row, in order, and
    where each row's begin; a shorter row's whole sequence is one run, a
    row without words has none."""
    counts = np.diff(rows)
    runs = np.maximum(counts - width + 1, np.minimum(counts, 1))
    begins = np.r_[0, np.cumsum(runs)]
    out = np.zeros(begins[-1], np.uint64)
    factor = np.uint64(_FACTOR)
    row = np.repeat(np.arange(len(counts)), runs)
    at = rows[row] + np.arange(begins[-1]) - begins[row]
    left = rows[row + 1] - at
    for k in range(width):
        has = left > k
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else out
        out = np.where(has, out * factor + word, out)
    return mix(out), begins


class Lookup:
    """Places of hashes in a sorted list, with a bit table in front."""

    def __init__(self, keys: np.ndarray) -> None:
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.table = np.zeros(_TABLE + 1, dtype=bool)
        self.table[(keys & np.uint64(_TABLE)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``hashes``, key numbers) of all that occur."""
        at = np.flatnonzero(self.table[(hashes & np.uint64(_TABLE)).astype(np.int64)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[place] == hashes[at]
        return at[hit], self.order[place[hit]]
