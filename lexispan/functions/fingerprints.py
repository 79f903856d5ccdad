"""Winnowed q-gram fingerprints of a string (numpy, per row).

Every q-gram (``q`` consecutive code points) gets a 64-bit hash; in each
window of ``w`` consecutive q-grams the leftmost smallest hash is
selected. The choice depends only on the window's content, so a string
``p`` of at least ``w + q - 1`` code points selects, wherever it occurs
inside a longer text, the same positions (relative to its start) with
the same hashes as it does on its own. Joining a passage's selected
hashes against a text's therefore finds every occurrence as a
candidate; candidates are then checked on the text itself.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

# Fixed values: (q, w) of each level, coarsest first. A string uses the
# first level whose minimum length w + q - 1 it reaches; (1, 1) selects
# every position and takes strings of any length.
LEVELS = ((16, 32), (4, 8), (1, 1))

# Window starts handled per piece of a long text (bounds task memory).
BLOCK = 1 << 22

_BASE = np.uint64(1_000_003)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def min_length(level: int) -> int:
    q, w = LEVELS[level]
    return w + q - 1


def level_of(length: int) -> int:
    """Coarsest level a string of ``length`` code points can use."""
    for lvl in range(len(LEVELS)):
        if length >= min_length(lvl):
            return lvl
    return len(LEVELS) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def gram_hashes(cps: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q-gram (uint64 arithmetic wraps by design)."""
    n = cps.shape[0] - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for j in range(q):
            h = h * _BASE + cps[j:j + n]
        h ^= h >> np.uint64(30)
        h *= _MIX1
        h ^= h >> np.uint64(27)
        h *= _MIX2
        h ^= h >> np.uint64(31)
    return h


def winnow(text: str, level: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes as int64) selected at ``level``; positions are
    code-point offsets of the q-gram starts, ascending, unique.

    A long text is taken in blocks of ``block`` window starts (each
    block reads the ``w + q - 2`` characters after it too), so memory
    stays bounded; the selections are the same as in one piece.
    """
    q, w = LEVELS[level]
    if len(text) <= block + w + q - 2:
        return _winnow_piece(text, q, w)
    pos_parts, h_parts = [], []
    for start in range(0, len(text) - (w + q - 2), block):
        pos, h = _winnow_piece(text[start:start + block + w + q - 2], q, w)
        pos_parts.append(pos + start)
        h_parts.append(h)
    pos, first = np.unique(np.concatenate(pos_parts), return_index=True)
    return pos, np.concatenate(h_parts)[first]


def _winnow_piece(text: str, q: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    h = gram_hashes(code_points(text), q)
    if h.shape[0] < w:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if w == 1:
        pos = np.arange(h.shape[0], dtype=np.int64)
    else:
        picks = sliding_window_view(h, w).argmin(axis=1) + np.arange(h.shape[0] - w + 1)
        pos = np.unique(picks).astype(np.int64)
    return pos, h[pos].view(np.int64)
