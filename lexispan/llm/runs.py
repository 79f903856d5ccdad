"""Periodic runs of words by enumerating maximal pairs.

A run of smallest period ``q`` that starts at ``s`` and is ``length``
words long is the maximal pair (s, s + q) of a repeat of length - q
words: the words to the left of the two places differ, and so do the
words after the repeat. So no candidate has to be extended. The suffixes
of each document are sorted, their LCP intervals are visited bottom-up,
and every interval keeps the sorted places of its suffixes by the word
to their left. Where two parts of an interval meet, places of different
left words whose distance meets the length constraints are runs.

A repeat that can give a run has ``DEPTH`` words or more, so only
suffixes whose first DEPTH words occur again in the document are sorted
further. Places of a repeat of h words that are at most h / 2 apart lie
in one arithmetic progression, all but its first place with the same left
word. So of each left word only the farthest place before and the nearest
place after are looked at; what they don't give is a run with a multiple
of its period, or is found where the smaller distance meets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import let
from lexispan.llm.words import column_bytes, row_slices

#: Least words of a run, and how often its period fits at least.
SHORTEST, EXPONENT = 24, 3
#: Pattern of a word: a longest run outside 0x09-0x0D and 0x20.
WORD = "([^\\x20\\x09-\\x0D]+)"

Run = tuple[int, int, int]


def _depth(shortest: int, exponent: int) -> int:
    """Largest power of two that no repeat of a run is shorter than."""
    least = -(-shortest * (exponent - 1) // exponent)
    return 1 << max(least.bit_length() - 1, 0)


def sorted_suffixes(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``words`` whose first ``depth`` words occur again, in
    order, and the rank of those first words. The documents' ends must
    be words of their own, so that all suffixes differ."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.empty(n, np.int64)
    fresh = np.r_[True, words[order[1:]] != words[order[:-1]]]
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]

    def repeated(places: np.ndarray) -> np.ndarray:
        """Of places sorted by rank, those whose rank occurs again."""
        same = rank[places[1:]] == rank[places[:-1]]
        return places[np.r_[False, same] | np.r_[same, False]] if len(places) else places
    left, width, found, first = repeated(order), 1, order[:0], order[:0]
    while True:
        if width == depth:
            found, first = left, rank[left]
        if not len(left):
            return found[np.lexsort((rank[found], first))], np.sort(first)
        second = rank[np.minimum(left + width, n - 1)]
        left = left[np.lexsort((second, rank[left]))]
        old, second = rank[left], rank[np.minimum(left + width, n - 1)]
        group = np.r_[True, old[1:] != old[:-1]]
        fresh = group | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(left))
        rank[left] = old + at[fresh][np.cumsum(fresh) - 1] - at[group][np.cumsum(group) - 1]
        left, width = repeated(left), 2 * width


def common_lengths(words: list[int], order: list[int], starts: list[bool], depth: int) -> list[int]:
    """Length of each suffix's common start with the one before it in
    ``order`` (0 where a group starts), in the order of the text so that
    each word is compared about once."""
    before = {place: order[i - 1] for i, place in enumerate(order) if not starts[i]}
    lengths = dict.fromkeys(order, 0)
    last, h = -2, depth
    for place in sorted(before):
        h = max(h - 1, depth) if place == last + 1 else depth
        other = before[place]
        while words[place + h] == words[other + h]:
            h += 1
        lengths[place], last = h, place
    return [lengths[place] for place in order]


class _Interval:
    """Sorted places of an interval's suffixes, all and by left word."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int) -> None:
        self.all = [place]
        self.by_left = {left: [place]}

    def pairs_with(self, other: _Interval, reach: int) -> Iterator[tuple[int, int]]:
        """Maximal pairs (earlier, later) with places of ``other``."""
        for left, places in other.by_left.items():
            for place in places:
                at = bisect_left(self.all, place - reach)
                if at == len(self.all) or self.all[at] > place + reach:
                    continue
                for own, near in self.by_left.items():
                    if own == left:
                        continue
                    at = bisect_left(near, place - reach)
                    if at < len(near) and near[at] < place:
                        yield near[at], place
                    at = bisect_right(near, place)
                    if at < len(near) and near[at] <= place + reach:
                        yield place, near[at]

    def take(self, other: _Interval) -> None:
        _merge(self.all, other.all)
        for left, places in other.by_left.items():
            if left in self.by_left:
                _merge(self.by_left[left], places)
            else:
                self.by_left[left] = places


def _merge(into: list[int], places: list[int]) -> None:
    if len(places) < 8:
        for place in places:
            insort(into, place)
    else:
        into.extend(places)
        into.sort()


def runs_of(words: list[int], order: list[int], lengths: list[int], shortest: int = SHORTEST,
            exponent: int = EXPONENT) -> dict[tuple[int, int], int]:
    """Smallest period by (start, end) of all runs whose suffixes are in
    ``order``; ``lengths`` as by ``common_lengths``. A place's left word
    is the one before it, which at a document's start is another
    document's end."""
    found: dict[tuple[int, int], int] = {}

    def joined(one: _Interval, two: _Interval, h: int) -> _Interval:
        large, small = (one, two) if len(one.all) >= len(two.all) else (two, one)
        if len(large.by_left) > 1 or large.by_left.keys() != small.by_left.keys():
            for a, b in large.pairs_with(small, h // (exponent - 1)):
                period = b - a
                if h + period >= shortest and period < found.get((a, b + h), period + 1):
                    found[a, b + h] = period
        large.take(small)
        return large

    stack: list[tuple[_Interval, int]] = []
    current = None
    for place, h in zip(order, lengths, strict=True):
        if current is not None:
            while stack and stack[-1][1] >= h:
                below, common = stack.pop()
                current = joined(below, current, common)
            if h:
                stack.append((current, h))
        current = _Interval(place, words[place - 1])
    while stack:
        below, common = stack.pop()
        current = joined(below, current, common)
    return found


def _word_lists(texts: pa.Array) -> list[list[bytes]]:
    data, starts = column_bytes(texts)
    return [data[a:b].tobytes().split() for a, b in zip(starts[:-1], starts[1:], strict=True)]


def text_runs(rows: list[list[bytes]], shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[list[Run]]:
    """Runs (start, length, period) of each list of words, by start, then
    period."""
    depth = _depth(shortest, exponent)
    numbers: dict[bytes, int] = {}
    ids = np.array([-1, *(i for n, row in enumerate(rows)
                          for i in (*[numbers.setdefault(w, len(numbers)) for w in row], -2 - n))], np.int64)
    # The same word of two documents counts as two words.
    begins = np.cumsum([1, *(len(row) + 1 for row in rows)])
    own = ids + np.repeat(np.arange(len(rows) + 1), np.diff(np.r_[0, begins])) * (len(numbers) + len(rows) + 2)
    order, first = sorted_suffixes(own, depth)
    out: list[list[Run]] = [[] for _ in rows]
    if len(order):
        starts = np.r_[True, first[1:] != first[:-1]].tolist()
        words, places = ids.tolist(), order.tolist()
        found = runs_of(words, places, common_lengths(words, places, starts, depth), shortest, exponent)
        for (start, end), period in sorted(found.items(), key=lambda r: (r[0][0], r[1])):
            row = int(np.searchsorted(begins, start, "right")) - 1
            out[row].append((start - int(begins[row]), end - start, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words outside what follows the first period of any run."""
    if not runs:
        return b" ".join(words)
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period:start + length] = b"\1" * (length - period)
    return b" ".join([word for word, drop in zip(words, gone, strict=True) if not drop])


def _find(shortest: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in row_slices(batch.column("text"), 1 << 20):
                rows = _word_lists(batch.column("text").slice(at, end - at))
                found = text_runs(rows, shortest, exponent)
                flat = [run for runs in found for run in runs]
                parts = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
                offsets = np.cumsum([0, *map(len, found)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, end - at), pa.array([len(row) for row in rows], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                         parts, ["start", "length", "period"])),
                     pa.array([collapsed(*row).decode() for row in zip(rows, found, strict=True)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
              exponent: int = EXPONENT) -> DataFrame:
    """Periodic runs of every whole text; one row per input row.

    Returns doc_id, n_words, runs (array of start, length, period by
    start, then period) and collapsed, the text's words joined by one
    space without what follows the first period of any run. A run is a
    stretch of at least ``shortest`` words and ``exponent`` (3 or more)
    smallest periods that no neighbouring word extends. Null and empty
    texts have no words and no runs; repeated rows give equal rows; an
    empty table gives an empty result; other columns are not read.
    """
    if exponent < 3 or shortest < 2:
        raise ValueError("exponent must be at least 3, shortest at least 2")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_find(shortest, exponent), "doc_id long, n_words long, "
                            "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(doc_id: Column, text: Column) -> Column:
    """Whole texts of which every tenth (by hash of the id) repeats its
    words from some place on; the words of those are joined by one space."""
    h = F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        shape = F.struct((g % n).alias("a"), (F.floor((n - g % n) / (F.lit(3) + g % 8)) + 1).alias("p"))
        return F.when(n == 0, F.lit("")).otherwise(let(shape, lambda s: F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.element_at(words, F.when(i < s["a"], i).otherwise(
                s["a"] + (i - s["a"]) % s["p"]).cast("int") + 1)), " ")))
    whole = F.coalesce(text, F.lit(""))
    return F.when(h % 10 == 0, let(F.regexp_extract_all(whole, F.lit(WORD), F.lit(1)), repeat)).otherwise(whole)


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length for its period
    (start, length, period, exponent_milli; nulls without runs),
    runs_sha256 and collapsed_sha256. Quotients of numbers below 2^26
    compare in doubles as they do exactly."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-(r["length"] / r["period"])).alias("order"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                           F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
                           F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), F.col("best.period")
    return digests.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor((length * 1000 - (length * 1000) % period) / period).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
