"""Plain-Python statement of the rules, used as a brute-force oracle in tests.

Spark code paths.
"""

from __future__ import annotations

import math
import re

from lexispan.functions.text import STOP_WORDS

STOP = set(STOP_WORDS)


def words(text):
    return [w for w in re.findall(r"[A-Za-z0-9_]+", text.lower()) if w not in STOP]


def windows(s, e, n):
    return [(a, min(a + n, e)) for a in range(s, e, n)]


def emit(text, s, e, n):
    return [] if not text[s:e].strip() else windows(s, e, n)


def paragraphs(text):
    out, pos = [], 0
    for m in re.finditer(r"\n\n+", text):
        if m.start() > pos:
            out.append((pos, m.start()))
        pos = m.end()
    if pos < len(text):
        out.append((pos, len(text)))
    return out


def pack(text, n):
    bufs = []
    for s, e in paragraphs(text):
        if bufs and e - bufs[-1][0] <= n:
            bufs[-1] = (bufs[-1][0], e)
        else:
            bufs.append((s, e))
    out = []
    for s, e in bufs:
        out += emit(text, s, e, n)
    return out


def bm25_rank(chunks, query, k, k1=1.0, b=0.4):
    """chunks: list of (path, first, last, text) in corpus order.
    Returns [(path, first, score)] best first (stable on ties)."""
    toks = [words(p) + words(t) for p, _, _, t in chunks]
    n = len(toks)
    avgdl = sum(len(t) for t in toks) / n
    df = {}
    for t in toks:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    avg = sum(raw.values()) / len(raw)
    idf = {w: (0.25 * avg if v < 0 else v) for w, v in raw.items()}
    q = words(query)
    if k <= 0 or not q or not any(w in idf for w in q):
        return []
    scores = []
    for t in toks:
        dl = len(t)
        s = 0.0
        for w in q:
            tf = t.count(w)
            if tf:
                s += idf.get(w, 0.0) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
        scores.append(s)
    order = sorted(range(n), key=lambda i: -round(scores[i], 9))
    return [(chunks[i][0], chunks[i][1], scores[i]) for i in order[:k]]
