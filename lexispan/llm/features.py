"""Sparse document features shared by the classifiers: hashed words and
binned statistics of a text's structure. Ids, sources, languages and
labels are never read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lexispan.llm.words import column_bytes, mix, word_bounds, word_hashes

#: Statistics, in the order of their columns in ``structure``.
STATISTICS = ["bytes", "words", "upper", "digits", "marks", "pipes", "breaks", "word_bytes",
              "distinct", "repeats", "ends", "top_word"]
BINS = 24

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?|"]] = True


def _per_row(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[starts[1:]] - total[starts[:-1]]


def structure(texts: pa.Array, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Statistics of each row; empty texts have zeros."""
    data, starts = column_bytes(texts)
    size = np.diff(starts)
    count = np.diff(rows)
    letters = _per_row(_LETTERS[data], starts)
    upper = _per_row((data >= 65) & (data <= 90), starts)
    share = lambda part, whole: part / np.maximum(whole, 1)
    row = np.repeat(np.arange(len(count)), count)
    # One sort of row number and hash in one integer; slices of a column
    # have far fewer than 2^24 rows.
    code = (row.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24))
    code.sort()
    first = np.ones(len(code), dtype=bool)
    first[1:] = code[1:] != code[:-1]
    distinct = _per_row(first, rows)
    # Occurrences of each row's most frequent word.
    at = np.flatnonzero(first)
    times = np.diff(np.r_[at, len(code)])
    top = np.zeros(len(count), np.int64)
    np.maximum.at(top, row[at], times)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    ends = _per_row((data == 46) | (data == 63), starts)
    return np.column_stack([
        np.log1p(size), np.log1p(count), share(upper, letters), share(_per_row((data >= 48) & (data <= 57), starts), size),
        share(_per_row(_MARKS[data], starts), size), share(_per_row(data == 124, starts), size),
        share(_per_row(data == 10, starts), size), share(size, count), share(distinct, count),
        share(_per_row(same, rows), count), share(ends, count), share(top, count)])


def word_counts(words: np.ndarray, rows: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, count, begins): each row's distinct word buckets."""
    count = np.diff(rows)
    row = np.repeat(np.arange(len(count)), count)
    code = row * buckets + (mix(words) % np.uint64(buckets)).astype(np.int64)
    code.sort()
    first = np.ones(len(code), dtype=bool)
    first[1:] = code[1:] != code[:-1]
    at = np.flatnonzero(first)
    begins = np.searchsorted(code[at] // buckets, np.arange(len(count) + 1)) if len(code) else np.zeros(len(count) + 1, np.int64)
    return code[at] % buckets, np.diff(np.r_[at, len(code)]), begins
