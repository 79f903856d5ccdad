"""License notices by an exact set-similarity join of text blocks and
templates.

A text is read in blocks of words that overlap by half, twice as long as
the templates they are held against. A block holds a template when the
share of the template's distinct words that the block has reaches the
template's threshold. Words are ordered by their frequency in the whole
corpus, rarest first. A template that needs ``need`` of its words shares
one of its first size - need + 1 words with every such block, and the
block has it among its own first words by the same count (prefix
filter). The join is on these words; pairs whose block is too small
(length filter) or whose words left after the meeting place are too few
(positional filter) go, and the rest are verified on all words. Only
words of some template take part: others are in no intersection.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import shared_table
from lexispan.llm.words import column_bytes, row_slices

# Letters to lower case, all other ASCII but digits to spaces.
_READ = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Least words of half a block.
LEAST_HALF = 4


@dataclass(frozen=True)
class Template:
    """A notice to look for: a block must hold ``threshold`` of its
    distinct words, or with ``phrase`` all its words in a row."""

    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.encode().translate(_READ).decode().split()

    @property
    def half(self) -> int:
        """Words of half a block: the power of two that holds the text."""
        return max(LEAST_HALF, 1 << (len(self.words) - 1).bit_length())

    @property
    def need(self) -> int:
        """Least common distinct words of a block that holds the template."""
        size = len(set(self.words))
        return size if self.phrase else max(-(-round(1000 * self.threshold) * size // 1000), 1)


#: Phrases whose places are counted (fixed values).
BASE = (
    Template("mit", "under the mit license", phrase=True),
    Template("apache-2", "apache license version 2", phrase=True),
    Template("cc-by-nc", "cc by nc", phrase=True),
)
#: Further notices: short ones as phrases, longer ones by containment.
FURTHER = (
    Template("gpl", "gnu general public license", phrase=True),
    Template("lgpl", "gnu lesser general public license", phrase=True),
    Template("agpl", "gnu affero general public license", phrase=True),
    Template("mpl-2", "mozilla public license v 2", phrase=True),
    Template("cc-by-sa", "cc by sa", phrase=True),
    Template("cc0", "cc0 1 0 universal", phrase=True),
    Template("all-rights-reserved", "all rights reserved", phrase=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files, to deal in the Software without restriction, including without "
             "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
             "all copies"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met: Redistributions of source code must retain the above "
             "copyright notice"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of "
             "the License at apache org licenses LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to "
             "copy, modify, publish, use, compile, sell, or distribute this software"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


def _numbered(templates: Sequence[Template]) -> dict[str, int]:
    """Numbers of all words of the templates."""
    return {w: i for i, w in enumerate(sorted({w for t in templates for w in t.words}))}


def _template_words(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, end in row_slices(batch.column("text"), 1 << 20):
                data, starts = column_bytes(batch.column("text").slice(at, end - at))
                sizes, places, words, ends = [], [], [], [0]
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    own = data[a:b].tobytes().translate(_READ).split()
                    found = [i for i, w in enumerate(own) if w in vocabulary]
                    places += found
                    words += [vocabulary[own[i]] for i in found]
                    sizes.append(len(own))
                    ends.append(len(places))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(sizes))), batch.column("id").slice(at, end - at),
                     pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(words, pa.int32()))],
                    names=["row", "doc_id", "n_words", "places", "words"])
                row += len(sizes)
    return run


def _filtered_blocks(halves: dict[int, tuple[int, np.ndarray]], rank: np.ndarray):
    """Blocks of each width that have, among their first words, a word a
    template may meet them by: ``halves`` has the least need and whether
    each rank is in a template's prefix."""
    def blocks(row: int, places: np.ndarray, ranks: np.ndarray) -> Iterator[tuple]:
        for half, (need, in_prefix) in halves.items():
            meet = in_prefix[ranks]
            if not meet.any():
                continue
            wanted = places[meet] // half
            wanted = np.unique(np.r_[wanted, wanted - 1])
            for block in wanted[wanted >= 0].tolist():
                a, b = np.searchsorted(places, (block * half, (block + 2) * half))
                own = np.unique(ranks[a:b])
                if len(own) >= need and in_prefix[own[:len(own) - need + 1]].any():
                    yield row, half, block, own.tolist(), places[a:b].tolist(), ranks[a:b].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int32())] * 3]
        names = ["row", "half", "block", "held", "places", "words"]
        for batch in batches:
            found = []
            for row, places, words in zip(batch.column("row").to_pylist(), batch.column("places"),
                                          batch.column("words"), strict=True):
                ranks = rank[words.values.to_numpy()] if len(words) else rank[:0]
                found.extend(blocks(row, places.values.to_numpy(), ranks))
                if len(found) >= 4096:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
    return run


def template_words(docs: DataFrame, templates: Sequence[Template], id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Each document's n_words and its words that are a template's:
    places (from 0) and word numbers, in text order."""
    vocabulary = {w.encode(): i for w, i in _numbered(templates).items()}
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return shared_table(texts.mapInArrow(
        _template_words(vocabulary), "row long, doc_id long, n_words long, places array<int>, words array<int>"), "words")


def template_matches(read: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Blocks of ``read`` (see ``template_words``) that hold a template.

    Returns row, template (its number), label, block_start (words from
    0), containment, first_word and last_word of the template's words in
    the block, and n_places, first_place, last_place of a phrase's
    places that start in the block's first half; a block without such a
    place does not hold the phrase.
    """
    spark = read.sparkSession
    vocabulary = _numbered(templates)
    # One row for each word of the templates.
    counts = {r["word"]: r["count"] for r in read.select(F.explode("words").alias("word")).groupBy("word").count().collect()}
    order = sorted(vocabulary.values(), key=lambda w: (counts.get(w, 0), w))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    rows, meets, halves = [], [], {}
    for number, t in enumerate(templates):
        sequence = [int(rank[vocabulary[w]]) for w in t.words]
        own = sorted(set(sequence))
        rows.append((number, t.label, t.half, t.need, t.phrase, own, sequence))
        meets += [(number, t.half, word, at, len(own), t.need) for at, word in enumerate(own[:len(own) - t.need + 1])]
        need, in_prefix = halves.get(t.half, (t.need, np.zeros(len(order), dtype=bool)))
        in_prefix[own[:len(own) - t.need + 1]] = True
        halves[t.half] = min(need, t.need), in_prefix
    # Both tables are the templates' own size, whatever the corpus.
    listed = spark.createDataFrame(rows, "template int, label string, _half int, _need int, phrase boolean, "
                                         "own array<int>, sequence array<int>")
    meets = spark.createDataFrame(meets, "template int, half int, word int, _at int, _size int, _need int")
    blocks = read.select("row", "places", "words").mapInArrow(
        _filtered_blocks(halves, rank),
        "row long, half int, block long, held array<int>, places array<int>, words array<int>")
    spread = blocks.select("*", F.posexplode("held").alias("at", "word"))
    size = F.size("held")
    most = F.least("at", "_at") + 1 + F.least(size - F.col("at") - 1, F.col("_size") - F.col("_at") - 1)
    met = spread.join(F.broadcast(meets), ["half", "word"]).where(
        (size >= F.col("_need")) & (F.col("at") <= size - F.col("_need")) & (most >= F.col("_need")))
    both = F.array_intersect("held", "own")
    # Both lists go by rank: a pair that meets twice counts at the first.
    sure = met.join(F.broadcast(listed.drop("_half", "_need")), "template").where(
        (both[0] == F.col("word")) & (F.size(both) >= F.col("_need")))
    length = F.size("sequence")
    start = F.col("block") * F.col("half")
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("places") - length, F.lit(0))),
        lambda i: (F.slice("words", i + 1, length) == F.col("sequence"))
        & (F.element_at("places", F.least(i + length, F.size("places"))) - F.element_at("places", i + 1) == length - 1)
        & (F.element_at("places", i + 1) < start + F.col("half")))
    inside = F.transform(F.filter(F.arrays_zip("places", "words"), lambda p: F.array_contains("own", p["words"])),
                         lambda p: p["places"])
    found = sure.select(
        "row", "template", "label", "phrase", start.alias("block_start"),
        F.round(F.size(both) / F.size("own"), 6).alias("containment"), inside.alias("inside"),
        F.when(F.col("phrase"), F.transform(starts, lambda i: F.element_at("places", i + 1))).alias("starts"))
    return found.where(~F.col("phrase") | (F.size("starts") > 0)).select(
        "row", "template", "label", "block_start", "containment",
        F.element_at("inside", 1).cast("long").alias("first_word"),
        F.element_at("inside", -1).cast("long").alias("last_word"),
        F.when(F.col("phrase"), F.size("starts")).cast("long").alias("n_places"),
        F.element_at("starts", 1).cast("long").alias("first_place"),
        F.element_at("starts", -1).cast("long").alias("last_place"))


def license_digest(read: DataFrame, matches: DataFrame, n_base: int) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    and score of every document; the first ``n_base`` templates are the
    base. The score is the largest containment of a template found."""
    base = F.col("template") < n_base
    sums = matches.groupBy("row").agg(
        F.sum(F.when(base, F.col("n_places"))).alias("n_base"),
        F.min(F.when(base, F.col("first_place"))).alias("first_word"),
        F.max(F.when(base, F.col("last_place"))).alias("last_word"),
        # Distinct labels: no more than there are templates.
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("containment").alias("score"))
    return read.select("row", "doc_id", "n_words").join(sums, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: Sequence[Template] = (*BASE, *FURTHER), n_base: int = len(BASE)) -> DataFrame:
    """License notices of every whole text; one row per input row, see
    ``license_digest``. Words are runs of digits, letters and everything
    beyond ASCII, with A-Z lower-cased. Null and empty texts have no
    words; repeated rows give equal rows; an empty table gives an empty
    result; other columns are not read. ``templates`` are few: they are
    sent to all tasks.
    """
    read = template_words(docs, templates, id_col, text_col)
    return license_digest(read, template_matches(read, templates), n_base)
