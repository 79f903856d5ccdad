"""Alignment of two tokenizers' tokens, with corpus-wide counts of pairs.

Tokens of both sides that end at the same byte are linked; an id pair's
count says how many links of the whole corpus hold it. Counting spills
to the shared folder: a task sorts the (pair, document) records of its
texts by side B's id, then side A's, cuts them into radix partitions by
side B's id and writes each as a zstd run. The runs' totals, one number
for each pair, are merged by k-way heap merge, in as many levels as it
takes. As the merge goes by side B's id, all pairs of an id pass one
after the other, which gives the largest count of the id on the way. The
merged counts stream back over the runs' records, and each run hands on
one sum for each document. A pair held by a third of all documents is
one number a run where it is counted, and as many records as documents
in runs of bounded size where counts come back; the runs of a partition
are dealt to as many tasks as their records ask for.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import shared_table

#: Radix partitions of side B's ids.
PARTITIONS = 16
#: Records of a task's runs, and runs merged at a time.
RUN_RECORDS, FAN_IN = 1 << 20, 64
#: Rows of a zstd frame, so that a merge holds a frame of each run.
BLOCK_ROWS = 1 << 13
#: Records of a partition that one task streams counts back to.
TASK_RECORDS = 1 << 22
#: Units whose alignment a Python worker remembers.
REMEMBERED = 400_000
#: Characters of a text handled at a time.
PIECE_CHARS = 1 << 20

# White space of tokenizers' word patterns (fixed values).
_SPACE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
_MARK = "▁"


def tokenizer_paths() -> tuple[str, str]:
    """The default vocabularies' files: byte-level BPE and pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class _Aligned(dict):
    """Ids of a unit, side A's and side B's, as little-endian unsigned
    32-bit bytes, or False where a side's bytes differ from the unit's.

    A unit starts with white space that follows something else. Neither
    tokenizer merges across such a place, so units are encoded by
    themselves.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        # A byte's character in a byte-level vocabulary: printable Latin-1
        # ones stand for themselves, the rest follow from 256 on, in order.
        plain = [b for b in range(256) if chr(b) in ByteLevel.alphabet() and b != 32]
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        byte_of = {c: b for b, c in self.letters.items()}
        self.bytes_a = {i: bytes(byte_of[c] for c in t) if set(t) <= byte_of.keys() else t.encode()
                        for t, i in self.a.get_vocab().items()}
        self._marks = {c: self.a.encode(c, add_special_tokens=False).ids for c in ".,;:!?"}
        # Byte-level tokens spell a text that nothing normalises.
        self.a_spells = self.a.normalizer is None and isinstance(self.a.pre_tokenizer, ByteLevel)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, t in self.bytes_a.items():
            self.size_a[i] = len(t)
        self.size_b = np.array([len(p) for p in self.bytes_b])
        # Decimal digits of all ids, and which of them are written.
        ids = np.arange(max(len(self.size_a), len(self.size_b)))
        powers = 10 ** np.arange(len(str(len(ids))) - 1, -1, -1)
        self.digits = (ids[:, None] // powers % 10 + ord("0")).astype(np.uint8)
        self.written = np.column_stack([(ids[:, None] >= powers) | (powers == 1), np.ones(len(ids), dtype=bool)])
        self.blank = self.b.piece_to_id(_MARK)
        inner = {c for i, p in enumerate(pieces) if not self.b.is_byte(i) for c in p.lstrip(_MARK)[1:]}
        inner |= {c for p in pieces if p.startswith(_MARK) for c in p.lstrip(_MARK)}
        # Space that may stand inside a piece starts no unit.
        safe = "".join(c for c in _SPACE if c == " " or c not in inner)
        if _MARK in inner:
            raise ValueError("a piece goes on after a space")
        other = "".join(c for c in _SPACE if c not in safe)
        more = f"(?:[{other}][{_SPACE}]*(?:[^{_SPACE}]+|\\Z))*" if other else ""
        self.units = re.compile(f"[{_SPACE}]*[^{_SPACE}]+{more}|[{_SPACE}]+")
        self.border = re.compile(f"(?<=[^{_SPACE}])(?=[{safe}])")

    def _ids_a(self, unit: str) -> list[int]:
        word = unit[1:]
        if word.isalpha():
            # One word of the tokenizer: straight to its merges.
            return [t.id for t in self.a.model.tokenize(unit.encode().decode("latin-1").translate(self.letters))]
        if len(word) > 1 and word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self._ids_a(unit[:-1]) + self._marks[word[-1]]
        return self.a.encode(unit, add_special_tokens=False).ids

    def _ids_b(self, units: list[str]) -> Iterator[list[int]]:
        # The model puts a space before a text; a unit's own one stands for it.
        found = self.b.encode([u.removeprefix(" ") for u in units], num_threads=1)
        for unit, ids in zip(units, found, strict=True):
            yield [self.blank] if unit == " " else ids if unit[0] == " " else ids[1:]

    def learn(self, units: list[str]) -> dict[str, tuple[bytes, bytes] | bool]:
        """Ids of units that are not remembered yet."""
        found = {}
        for unit, ids_b in zip(units, self._ids_b(units), strict=True):
            ids_a, raw = self._ids_a(unit), unit.encode()
            spelt = b"".join(map(self.bytes_b.__getitem__, ids_b)) == raw and (
                self.a_spells or b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw)
            found[unit] = spelt and (array("I", ids_a).tobytes(), array("I", ids_b).tobytes())
        if len(self) + len(found) > REMEMBERED:
            self.clear()
        self.update((u, f) for u, f in found.items() if len(u) <= 64)
        return found

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about PIECE_CHARS that end with a unit."""
        at = 0
        while len(text) - at > PIECE_CHARS:
            cut = self.border.search(text, at + PIECE_CHARS)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def ids(self, piece: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids of a piece, None where a side spells it differently."""
        units = self.units.findall(piece)
        found = list(map(self.get, units))
        if None in found:
            fresh = self.learn(list({u for u, f in zip(units, found, strict=True) if f is None}))
            found = [fresh[u] if f is None else f for u, f in zip(units, found, strict=True)]
        if False in found:
            return None
        ids_a, ids_b = zip(*found, strict=True)
        return np.frombuffer(b"".join(ids_a), "<u4"), np.frombuffer(b"".join(ids_b), "<u4")

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Text of the groups (``a1,a2|b1;`` for each) and the pairs
        (B id * 2^32 + A id) of the links of two sides of one text. Tokens
        have bytes, so one token of a side ends at a place."""
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        of_a, of_b = np.zeros(ends_a[-1] + 1, dtype=bool), np.zeros(ends_a[-1] + 1, dtype=bool)
        of_a[ends_a], of_b[ends_b] = True, True
        closes_a, closes_b = of_b[ends_a], of_a[ends_b]
        last_a, last_b = np.flatnonzero(closes_a), np.flatnonzero(closes_b)
        # A group's A tokens stand after the B tokens of the groups before.
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        at_a = np.arange(len(ids_a)) + np.r_[0, last_b + 1][group_a]
        at_b = np.arange(len(ids_b)) + (last_a + 1)[group_b]
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        ids[at_a], ids[at_b] = ids_a, ids_b
        rows = np.empty((len(ids), self.digits.shape[1] + 1), np.uint8)
        rows[:, :-1], rows[:, -1] = self.digits[ids], ord(",")
        rows[at_a[last_a], -1], rows[at_b[last_b], -1] = ord("|"), ord(";")
        pairs = ids_b[last_b].astype(np.int64) << 32 | ids_a[last_a]
        return rows[self.written[ids]].tobytes(), pairs

    def of(self, text: str | None) -> tuple[tuple[int, int, int, int, str], np.ndarray]:
        """Counts of a text's tokens, groups and links with its groups'
        digest, and its links' pairs."""
        nothing = (0, 0, 0, 0, ""), np.zeros(0, np.int64)
        if not text:
            return nothing
        digest, n_a, n_b, links, held = hashlib.sha256(), 0, 0, [], b""
        for piece in self.pieces(" " + text):
            ids = self.ids(piece)
            if ids is None:
                return nothing
            written, pairs = self.groups(*ids)
            digest.update(held + written[:-1])
            held, n_a, n_b = b";", n_a + len(ids[0]), n_b + len(ids[1])
            links.append(pairs)
        pairs = np.concatenate(links)
        return (n_a, n_b, len(pairs), len(pairs), digest.hexdigest()), pairs


_LOADED: dict[tuple[str, str], _Aligned] = {}


def aligned(text: str | None, path_a: str, path_b: str) -> tuple[tuple[int, int, int, int, str], np.ndarray]:
    """(tokens of A, of B, groups, links, digest of the groups), and the
    links' pairs (B id * 2^32 + A id) in order."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = _Aligned(path_a, path_b)
    return _LOADED[path_a, path_b].of(text)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as zstd frames of BLOCK_ROWS rows, each led
    by its size; the first column is sorted and kept as differences."""
    out = []
    for at in range(0, len(columns[0]), BLOCK_ROWS):
        block = [c[at:at + BLOCK_ROWS] for c in columns]
        block[0] = np.diff(block[0], prepend=block[0][:1] * 0)
        # Bytes of equal weight side by side compress well.
        raw = b"".join(c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in block)
        frame = zstandard.ZstdCompressor(level=1).compress(raw)
        out += [struct.pack("<I", len(frame)), frame]
    return b"".join(out)


def _blocks(packed: bytes, columns: int) -> Iterator[list[np.ndarray]]:
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(packed):
        size = struct.unpack_from("<I", packed, at)[0]
        raw = np.frombuffer(reader.decompress(packed[at + 4:at + 4 + size]), np.uint8)
        block = [np.ascontiguousarray(c.T).view("<i8").ravel() for c in raw.reshape(columns, 8, -1)]
        yield [np.cumsum(block[0]), *block[1:]]
        at += 4 + size


def _unpacked(packed: bytes, columns: int) -> list[np.ndarray]:
    blocks = list(_blocks(packed, columns))
    return [np.concatenate(c) for c in zip(*blocks, strict=True)]


def _totals(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``counts`` by runs of equal ``pairs``."""
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(counts, first)


_DOC = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_RUN = [("part", pa.int32()), ("run", pa.int64()), ("n_records", pa.int64()), ("records", pa.binary()),
        ("totals", pa.binary())]
_SPILL = pa.schema([*_DOC, *_RUN])
_SPILL_DDL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "part int, run long, n_records long, records binary, totals binary")


def _spilled(columns: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of some columns of the spill table, the others null."""
    names = [name for name, _ in columns]
    values = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(values[names.index(f.name)], f.type) if f.name in names else pa.nulls(len(rows), f.type)
         for f in _SPILL], schema=_SPILL)


def _runs(records: list[tuple[np.ndarray, np.ndarray, np.ndarray]], partitions: int, run: int) -> Iterator[tuple]:
    """Sorted runs of (pair, row, count) records, one for each partition."""
    pairs, rows, counts = (np.concatenate(c) for c in zip(*records, strict=True))
    part = (pairs >> 32) % partitions
    order = np.lexsort((rows, pairs, part))
    pairs, rows, counts, part = pairs[order], rows[order], counts[order], part[order]
    edges = np.searchsorted(part, np.arange(partitions + 1))
    for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if b > a:
            yield (p, run, int(b - a), _packed(pairs[a:b], rows[a:b], counts[a:b]),
                   _packed(*_totals(pairs[a:b], counts[a:b])))


def _spill(path_a: str, path_b: str, partitions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows and runs are numbered within the task's partition.
        row = run_id = TaskContext.get().partitionId() << 40
        held, size = [], 0
        for batch in batches:
            docs = []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                counts, pairs = aligned(text.as_py(), path_a, path_b)
                docs.append((row, doc_id, *counts))
                if len(pairs):
                    found, n = np.unique(pairs, return_counts=True)
                    held.append((found, np.full(len(found), row), n))
                    size += len(found)
                row += 1
                if size >= RUN_RECORDS:
                    yield _spilled(_RUN, list(_runs(held, partitions, run_id)))
                    held, size, run_id = [], 0, run_id + 1
            if docs:
                yield _spilled(_DOC, docs)
        if held:
            yield _spilled(_RUN, list(_runs(held, partitions, run_id)))
    return run


def _entries(packed: bytes) -> Iterator[tuple[int, int]]:
    for pairs, totals in _blocks(packed, 2):
        yield from zip(pairs.tolist(), totals.tolist(), strict=True)


def _merged(runs: pa.ChunkedArray) -> Iterator[tuple[int, int]]:
    """(pair, total) of several runs' totals in the order of the pairs:
    a heap holds the next pair of each run."""
    for pair, same in groupby(heapq.merge(*(_entries(run.as_py()) for run in runs)), itemgetter(0)):
        yield pair, sum(n for _, n in same)


def _merge_runs(key: tuple, table: pa.Table) -> pa.Table:
    """One run of the totals of a group of runs."""
    pairs, totals = array("q"), array("q")
    for pair, total in _merged(table["totals"]):
        pairs.append(pair)
        totals.append(total)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([key[1].as_py()], pa.int64()),
                     "totals": pa.array([_packed(np.array(pairs), np.array(totals))], pa.binary())})


def _best_counts(key: tuple, table: pa.Table) -> pa.Table:
    """The last merge of a partition: (pair, count, whether the count is
    the highest of its B id). Pairs come by B id, so the highest is known
    when the id changes."""
    pairs, counts, best = array("q"), array("q"), array("q")
    for _, same in groupby(_merged(table["totals"]), lambda entry: entry[0] >> 32):
        mine = list(same)  # at most one for each A id
        most = max(n for _, n in mine)
        pairs.extend(pair for pair, _ in mine)
        counts.extend(n for _, n in mine)
        best.extend(int(n == most) for _, n in mine)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                     "counts": pa.array([_packed(*map(np.array, (pairs, counts, best)))], pa.binary())})


def _stream_back(key: tuple, runs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums of some runs of a partition for each of their documents; a
    task may have been dealt none."""
    known, count, best = _unpacked(counts["counts"][0].as_py(), 3)
    names = ["row", "n_best", "count_sum"]
    found = [pa.table([pa.array([], pa.int64())] * 3, names=names)]
    for packed in runs["records"]:
        pairs, rows, n = _unpacked(packed.as_py(), 3)
        at = np.searchsorted(known, pairs)
        own, place = np.unique(rows, return_inverse=True)
        sums = np.zeros((2, len(own)), np.int64)
        np.add.at(sums[0], place, best[at] * n)
        np.add.at(sums[1], place, count[at] * n)
        found.append(pa.table([pa.array(own), pa.array(sums[0]), pa.array(sums[1])], names=names))
    return pa.concat_tables(found)


def pair_counts(spill: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(part, counts): the merged totals of all runs of ``spill``."""
    runs = spill.where("part is not null").select("part", "run", "totals")
    order = F.xxhash64("run")
    while True:
        most = runs.groupBy("part").count().agg(F.max("count")).first()[0] or 0
        if most <= fan_in:
            return shared_table(runs.groupBy("part").applyInArrow(_best_counts, "part int, counts binary"), "counts")
        # About half as many runs a group as the limit, by hash.
        groups = -(-2 * most // fan_in)
        runs = shared_table(runs.withColumn("run", F.pmod(order, F.lit(groups))).groupBy("part", "run").applyInArrow(
            _merge_runs, "part int, run long, totals binary"), "merged")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                    path_b: str | None = None, partitions: int = PARTITIONS, fan_in: int = FAN_IN) -> DataFrame:
    """Alignment of side A's (byte-level BPE) and side B's (pieces) tokens
    of every whole text; one row per input row.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair
    has the highest count of its B id, ties included), count_sum (counts
    of all links' pairs) and groups_sha256. Both sides read a space and
    the text. Null and empty texts, and texts that a side's tokens don't
    spell byte by byte, have no tokens: zeros and an empty digest, and
    they count nowhere. Repeated rows count as often as they occur; an
    empty table gives an empty result; other columns are not read.
    """
    default = tokenizer_paths()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spill = shared_table(texts.mapInArrow(_spill(path_a or default[0], path_b or default[1], partitions),
                                          _SPILL_DDL), "spill")
    counts = pair_counts(spill, fan_in)
    records = spill.where("part is not null").select("part", "run", "n_records", "records")
    # As many copies of a partition's counts as tasks share its runs.
    tasks = records.groupBy("part").agg(F.ceil(F.sum("n_records") / TASK_RECORDS).cast("int").alias("tasks"))
    tasks = F.broadcast(tasks)  # one row a partition
    dealt = records.join(tasks, "part").withColumn("task", F.pmod(F.xxhash64("run"), F.col("tasks")).cast("int"))
    spread = counts.join(tasks, "part").select(
        "part", "counts", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))
    back = dealt.select("part", "task", "records").groupBy("part", "task").cogroup(
        spread.groupBy("part", "task")).applyInArrow(_stream_back, "row long, n_best long, count_sum long")
    sums = back.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    plain = spill.where("row is not null").select(*(name for name, _ in _DOC))
    return plain.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
