"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``CAPACITY`` tokens. Only the number
of pieces of each length, at most CAPACITY rows, reaches the driver.
Best-fit decreasing runs over these counts: bins that are filled alike
are one entry with a count, so planning costs the same for any number of
documents. The plan says which ranks of each length go to which
sequences; pieces take their places by joining on their rank within
their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import gapless_rank, shared_table

CAPACITY = 1024
#: Token id that ends every document.
END = 2
#: Texts' units of a generation; a task remembers the ids of two.
REMEMBERED = 300_000
#: Bytes of texts whose units are told apart at a time.
SLICE = 1 << 22

# Units of a text: an optional space and a run of letters and digits, or
# of what follows up to white space; or white space, without the last of
# it before a word. Unit borders are borders of the tokenizer's own
# words, and a word is remembered once, whatever marks follow it.
_SPACE = r"\t-\r \x85\xa0  -     　"
_WORD, _MARK, _WHITE = range(3)
# A space at which a long text may be cut: a unit begins there.
_CUT = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def tokenizer_path() -> str:
    """The default vocabulary's file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Ids(dict):
    """Ids of a unit as little-endian unsigned 32-bit bytes, for a file
    of a byte-level BPE without normaliser.

    The units met last are kept. A full generation becomes the old one;
    an old unit that comes again belongs to the new one, so frequent
    units stay.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merged = self.tokenizer.model.tokenize
        self.old: dict[str, bytes] = {}
        # A byte's character in the vocabulary: printable Latin-1 ones
        # stand for themselves, the rest follow from 256 on, in order.
        plain = [b for b in range(256) if chr(b) in ByteLevel.alphabet() and b != 32]
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, unit: str) -> bytes:
        found = self.old.get(unit)
        if found is None:
            found = array("I", self._encoded(unit)).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if len(unit) <= 64:
            self[unit] = found
        return found

    def forget(self) -> None:
        """Give the memory back: the worker may go on to other work."""
        self.clear()
        self.old = {}
        pa.default_memory_pool().release_unused()

    def _encoded(self, unit: str) -> list[int]:
        word = unit.removeprefix(" ")
        if not word.isalpha():
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        # One word of the tokenizer: straight to its merges.
        if word.isascii():
            spelt = self.letters[32] + word if unit[0] == " " else word
        else:
            spelt = unit.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.merged(spelt)]


_LOADED: dict[str, _Ids] = {}


@cache
def _kinds() -> np.ndarray:
    """Of each code point whether it is a letter or digit, a mark or white space."""
    kinds = np.array([_WORD if chr(i).isalnum() else _MARK for i in range(0x110000)], np.uint8)
    kinds[[ord(c) for c in re.findall(f"[{_SPACE}]", "".join(map(chr, range(1 << 16))))]] = _WHITE
    return kinds


def _borders(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First characters of the units of texts, whose code points follow
    each other and which begin at ``starts``."""
    kinds = _kinds()[points]
    begins = np.zeros(len(points), bool)
    begins[starts[starts < len(points)]] = True
    turns = begins.copy()  # where white space or other characters begin
    turns[1:] |= (kinds[1:] == _WHITE) != (kinds[:-1] == _WHITE)
    runs = np.cumsum(turns, dtype=np.int32)
    first = turns.copy()
    # The last white space before a word begins a unit, which the word joins after a space.
    words = np.flatnonzero(turns & ~begins & (kinds != _WHITE))
    first[words - 1] = True
    first[words] = points[words - 1] != 32
    marks = np.flatnonzero(kinds == _MARK)
    marks = marks[np.diff(runs[marks], prepend=0) != 0]
    first[marks[~turns[marks]]] = True
    return np.flatnonzero(first)


def _slice_ids(data: np.ndarray, starts: np.ndarray, ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts that begin at the bytes ``starts`` of ``data``,
    and where those of each begin and end."""
    if not len(data):
        return np.empty(0, "<u4"), np.zeros(len(starts) + 1, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    at = np.flatnonzero((data & 0xC0) != 0x80)  # the byte of each character
    starts = np.searchsorted(at, starts)
    borders = _borders(points, starts)
    offsets = np.append(at[borders], len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(borders), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    found = [ids[unit] for unit in units.dictionary.to_numpy(zero_copy_only=False)]
    flat, codes = np.frombuffer(b"".join(found), "<u4"), units.indices.to_numpy()
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    ends = np.append(0, np.cumsum(sizes[codes]))
    places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], sizes[codes])
    places += np.arange(ends[-1])
    return flat[places], ends[np.append(np.searchsorted(borders, starts), len(borders))]


def _parts(data: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, bool]]:
    """End of each text, and of the parts of longer ones than SLICE, and
    whether a text ends there."""
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        while end - start > SLICE and (found := _CUT.search(data, start + SLICE, end)):
            start = found.start()
            yield start, False
        yield end, True


def texts_ids(texts: pa.Array, path: str) -> Iterator[bytes]:
    """Of each text (null: empty) the ids and the end id, four bytes each."""
    if path not in _LOADED:
        _LOADED[path] = _Ids(path)
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    begin, starts, whole, text = int(edges[0]), [int(edges[0])], [], []
    end = begin
    for end, ended in _parts(data, edges):
        whole.append(ended)
        if end - begin < SLICE:
            starts.append(end)
            continue
        yield from _ended(data[begin:end], starts, whole, text, _LOADED[path])
        begin, starts, whole = end, [end], []
    if whole:
        yield from _ended(data[begin:end], starts[:len(whole)], whole, text, _LOADED[path])


def _ended(data: np.ndarray, starts: list[int], whole: list[bool], text: list[bytes], ids: _Ids) -> Iterator[bytes]:
    """The texts that end in a slice; ``text`` keeps the parts of one that does not."""
    found, ends = _slice_ids(data, np.array(starts) - starts[0], ids)
    for low, high, ended in zip(ends[:-1].tolist(), ends[1:].tolist(), whole, strict=True):
        text.append(found[low:high].tobytes())
        if ended:
            yield b"".join([*text, END.to_bytes(4, "little")])
            text.clear()


def token_bytes(text: str, path: str) -> bytes:
    """A document's ids and the end id, four bytes each."""
    return next(texts_ids(pa.array([text], pa.string()), path))


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all full but the
    first, which holds the remainder."""
    first = length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id").to_pylist(), []
            for i, buffer in enumerate(texts_ids(batch.column("text"), path)):
                for n, (start, length) in enumerate(cut(len(buffer) // 4, capacity)):
                    rows.append((ids[i], n, start, length, zlib.crc32(buffer[4 * start:4 * (start + length)])))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if path in _LOADED:
            _LOADED[path].forget()
    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Returns rows (length, first rank, number of ranks, first sequence,
    pieces a sequence, offset): of a length's ranks, the stated range
    fills sequences one after the other, with the stated number of
    pieces in each from the stated offset on. Bins filled alike are kept
    as ranges of sequences by the room left; the smallest room that
    still fits is taken first, and a bin taken is filled with as many
    pieces of the length as fit, as best fit does piece by piece.
    """
    rooms: list[int] = []  # sorted sizes of room left
    bins: dict[int, list[tuple[int, int]]] = {}  # room: [(first sequence, number)]
    rows, sequences = [], 0

    def put(room: int, first: int, number: int) -> None:
        if number and room:
            if room not in bins:
                insort(rooms, room)
                bins[room] = []
            bins[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
            else:
                room, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            each = room // length
            whole = min(number, left // each)
            offset = capacity - room
            if whole:
                rows.append((length, rank, whole * each, first, each, offset))
                put(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if whole < number:
                if left:  # fewer than one bin takes: the last of this length
                    rows.append((length, rank, left, first + whole, left, offset))
                    put(room - left * length, first + whole, 1)
                    rank, left, whole = rank + left, 0, whole + 1
                put(room, first + whole, number - whole)
    return rows


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_pieces(path or tokenizer_path(), capacity),
                            "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   capacity: int = CAPACITY) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. A document is its ids and the end id; a null
    or empty text is the end id alone. Only documents over ``capacity``
    are cut. Repeated rows are packed as often as they occur, ties of a
    length go by id. An empty table gives an empty result; other columns
    are not read.
    """
    spark = docs.sparkSession
    cut_up = shared_table(pieces(docs, id_col, text_col, path, capacity), "pieces")
    # At most ``capacity`` rows: one for each length.
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = gapless_rank(cut_up, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")
    slots = spark.createDataFrame(
        plan(counts, capacity),
        "_length long, _first long, _ranks long, _sequence long, _each long, _offset long")
    # The plan has a bounded number of rows for each of at most
    # ``capacity`` lengths, whatever the number of documents.
    inside = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (
        F.col("_rank") < F.col("_first") + F.col("_ranks"))
    placed = ranked.join(F.broadcast(slots), inside)
    nth = F.col("_rank") - F.col("_first")
    within = F.pmod(nth, F.col("_each"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + ((nth - within) / F.col("_each")).cast("long")).alias("sequence_id"),
        (F.col("_offset") + within * F.col("length")).alias("offset"))
