"""Corpora, questions and gold spans derived from the driver tables.

* ``prose_corpus`` (F1): every ``documents`` row as a Markdown file whose
  line breaks become paragraph breaks.
* ``code_corpus`` (F3): Python files built from ``part``; each file holds
  the functions of one brand and one block of 100 part keys, so a file
  (one row) stays bounded however large ``part`` grows.
* ``gold_spans`` (F2): where each ``benchmark`` passage occurs in the
  prose corpus (first occurrence per file), found by a join of winnowed
  q-gram fingerprints and a check on the text: linear in the corpus,
  no pairwise join of passages and documents, nothing through the
  driver.
* question sets taken from ``benchmark`` and ``conversations``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions import fingerprints as fp
from lexispan.plans.parallelism import ensure_parallelism
from lexispan.session import ensure_checkpoint_dir

# Small sides of the gold-span joins are broadcast up to these checked
# sizes (fingerprints, passages, candidate starts, passage characters);
# larger ones are shuffled on the join key.
GOLD_BROADCAST_PRINTS = 4_000_000
GOLD_BROADCAST_PASSAGES = 1_000_000
GOLD_BROADCAST_CANDIDATES = 2_000_000
GOLD_BROADCAST_PASSAGE_CHARS = 64 * 1024 * 1024
CODE_BLOCK = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    return ensure_parallelism(df)


def prose_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, text)."""
    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        F.concat(F.lit("corpus/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".md")).alias("file_path"),
        F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("text"))


def code_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One function per part: (file_path, p_partkey, snippet)."""
    p = table(spark, sf_dir, "part")
    path = F.concat(F.lit("corpus/code/"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))),
                    F.lit("/block"), F.floor(F.col("p_partkey") / CODE_BLOCK).cast("string"),
                    F.lit(".py"))
    snippet = F.concat(F.lit("# "), F.col("p_type"), F.lit("\ndef f_"), F.col("p_partkey").cast("string"),
                       F.lit("(x):\n    return "), F.col("p_size").cast("string"), F.lit("\n\n"))
    return p.select(path.alias("file_path"), "p_partkey", snippet.alias("snippet"))


def code_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, text); functions in part-key order, <= 100 per file."""
    s = code_snippets(spark, sf_dir)
    return (s.groupBy("file_path")
            .agg(F.sort_array(F.collect_list(F.struct("p_partkey", "snippet"))).alias("parts"))
            .select("file_path", F.array_join(F.col("parts.snippet"), "").alias("text")))


def mixed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 and F3 together (both chunking strategies)."""
    return prose_corpus(spark, sf_dir).unionByName(code_corpus(spark, sf_dir))


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(question_id, question): each benchmark passage, whole, as a question."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("question_id"),
                    F.col("text").alias("question"))


def conversation_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(question_id, question): every user turn."""
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"),
                 F.col("turn").cast("string")).alias("question_id"),
        F.col("text").alias("question"))


def doc_id_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rare-token question per document (its id): exercises zero-fill."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("question_id"),
                    F.col("doc_id").cast("string").alias("question"))


def gold_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(question_id, passage) as it appears in F1 (newlines doubled)."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("question_id"),
                    F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("passage"))


# Fingerprints handed on at a time (a batch of texts has many times its size).
PRINT_ROWS = 1 << 17


def _passage_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every selected fingerprint of each passage at its own level."""
    for batch in batches:
        yield from _prints(batch, ["question_id", "lvl", "h", "o"], lambda passage: [fp.level_of(len(passage))])


def _text_prints(levels: list[int]):
    """mapInArrow function: selected fingerprints of each text at the
    levels some passage uses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _prints(batch, ["file_path", "lvl", "h", "pos"], lambda text: levels)
    return run


def _prints(batch: pa.RecordBatch, names: list[str],
            levels_of: Callable[[str], list[int]]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of a batch's texts (key, text), some texts at a
    time; null texts have none."""
    keys, texts = batch.columns
    rows, lvls, hs, offs, held = [], [], [], [], 0

    def taken() -> pa.RecordBatch:
        columns = [keys.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(lvls)),
                   pa.array(np.concatenate(hs)), pa.array(np.concatenate(offs))]
        return pa.RecordBatch.from_arrays(columns, names=names)
    for i, text in enumerate(texts):
        text = text.as_py()
        for lvl in levels_of(text) if text is not None else ():
            pos, h = fp.winnow(text, lvl)
            rows.append(np.full(len(pos), i))
            lvls.append(np.full(len(pos), lvl, dtype=np.int32))
            hs.append(h)
            offs.append(pos)
            held += len(pos)
        if held >= PRINT_ROWS:
            yield taken()
            rows, lvls, hs, offs, held = [], [], [], [], 0
    if held:
        yield taken()


def _maybe_broadcast(df: DataFrame, size: int, limit: int) -> DataFrame:
    return F.broadcast(df) if size <= limit else df


def gold_spans(spark: SparkSession, sf_dir: str, corpus: DataFrame | None = None) -> DataFrame:
    """(question_id, file_path, first_character_index, last_character_index)
    of every ``benchmark`` passage in the prose corpus."""
    corpus = corpus if corpus is not None else prose_corpus(spark, sf_dir)
    return locate_passages(corpus, gold_passages(spark, sf_dir))


def locate_passages(corpus: DataFrame, passages: DataFrame) -> DataFrame:
    """First occurrence of every passage ``(question_id, passage)`` in
    every file of ``corpus`` ``(file_path, text)``.

    Found without a pairwise join of passages and files: both sides are
    reduced to winnowed q-gram fingerprints (``functions.fingerprints``);
    each passage is anchored on its fingerprint that is rarest in the
    corpus, the corpus fingerprints are joined to the anchors, and each
    candidate start is checked against the text. Every occurrence is a
    candidate, so the result is exact.
    """
    spark = corpus.sparkSession
    ensure_checkpoint_dir(spark)
    passages = (passages.where(F.length("passage") > 0)
                .select("question_id", "passage", F.length("passage").alias("n")))
    level = F.lit(len(fp.LEVELS) - 1)
    for lvl in reversed(range(len(fp.LEVELS) - 1)):
        level = F.when(F.col("n") >= fp.min_length(lvl), F.lit(lvl)).otherwise(level)
    totals = passages.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("chars"),
                          F.sort_array(F.collect_set(level)).alias("levels")).first()
    n_rows, n_chars = int(totals["rows"] or 0), int(totals["chars"] or 0)
    schema = ("question_id string, file_path string, first_character_index bigint, "
              "last_character_index bigint")
    if n_rows == 0:
        return spark.createDataFrame([], schema)
    levels = [int(x) for x in totals["levels"]]  # at most len(LEVELS) values

    # A passage has at most one fingerprint per character: n_chars bounds them.
    pprints = spread(passages.select("question_id", "passage")).mapInArrow(
        _passage_prints, "question_id string, lvl int, h bigint, o bigint")
    keys = _maybe_broadcast(pprints.select("lvl", "h").distinct(), n_chars, GOLD_BROADCAST_PRINTS)
    tprints = corpus.select("file_path", "text").mapInArrow(
        _text_prints(levels), "file_path string, lvl int, h bigint, pos bigint")
    # Corpus fingerprints some passage shares; read twice below, so the
    # lineage is cut in the shared checkpoint folder.
    hits = tprints.join(keys, ["lvl", "h"], "left_semi").checkpoint()

    counts = hits.groupBy("lvl", "h").agg(F.count(F.lit(1)).alias("cnt"))
    anchors = (_maybe_broadcast(pprints, n_chars, GOLD_BROADCAST_PRINTS).join(counts, ["lvl", "h"])
               .groupBy("question_id").agg(F.min(F.struct("cnt", "o", "lvl", "h")).alias("a"))
               .join(passages.select("question_id", "n"), "question_id")
               .select("question_id", "a.lvl", "a.h", "a.o", "n"))
    cand = (hits.join(_maybe_broadcast(anchors, n_rows, GOLD_BROADCAST_PASSAGES), ["lvl", "h"])
            .select("question_id", "file_path", (F.col("pos") - F.col("o")).alias("start"), "n")
            .where(F.col("start") >= 0))
    n_cand = cand.count()
    seg = (_maybe_broadcast(cand, n_cand, GOLD_BROADCAST_CANDIDATES)
           .join(corpus.select("file_path", "text"), "file_path")
           .select("question_id", "file_path", "start", "n",
                   F.substring(F.col("text"), F.col("start") + 1, F.col("n")).alias("seg")))
    found = seg.join(_maybe_broadcast(passages.select("question_id", "passage"), n_chars,
                                      GOLD_BROADCAST_PASSAGE_CHARS), "question_id")
    return (found.where(F.col("seg") == F.col("passage"))
            .groupBy("question_id", "file_path")
            .agg(F.min("start").alias("first"), F.max("n").alias("n"))
            .select("question_id", "file_path", F.col("first").alias("first_character_index"),
                    (F.col("first") + F.col("n")).alias("last_character_index")))
