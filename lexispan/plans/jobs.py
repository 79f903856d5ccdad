"""Command-level jobs: the reference's commands as Spark jobs.

``index_corpus``      corpus directory or table -> saved BM25 index
``search_query``      one query -> ranked sources (R5)
``search_dataset``    question file -> results file (R6 + S10)
``answer_query``      one query -> sources + answer (G4)
``answer_dataset``    results file -> results-with-answers file (G3)
``evaluate``          results file + answered question file -> recall@c (E1-E6)
``load_dataset``      question file -> count message (S5-S7)
``copy_dataset``      question file -> validated copy (S8)

Errors are raised as exceptions (ValueError, FileNotFoundError,
NotADirectoryError, qs.InvalidDataset); nothing is printed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import normalize_newlines
from lexispan.operators import context as cx
from lexispan.operators import evaluate as ev
from lexispan.operators import index as ix
from lexispan.operators import search as se
from lexispan.operators.chunking import DEFAULT_CHUNK_SIZE, check_chunk_size
from lexispan.sources import corpus as co
from lexispan.sources import questions as qs
from lexispan.sources import sinks as sk

DEFAULT_INDEX_DIRECTORY = "data/processed"


def index_corpus(spark: SparkSession, corpus_dir: str | None = None,
                 index_dir: str = DEFAULT_INDEX_DIRECTORY, chunk_size: int = DEFAULT_CHUNK_SIZE,
                 documents: DataFrame | None = None, project_root: str | None = None,
                 mode: str = "strict") -> ix.BM25Index:
    """Ingest a corpus (directory, or a ``documents`` table with
    file_path/text) and persist its index. Size and output checks run
    before any job."""
    check_chunk_size(chunk_size)
    sk.check_output_directory(index_dir)
    if documents is None:
        if corpus_dir is None:
            raise ValueError("give corpus_dir or documents")
        documents = co.load_documents(spark, corpus_dir, project_root, mode)
    return ix.save_index(ix.build_index(documents, chunk_size, materialize=False), index_dir)


def _one_question(spark: SparkSession, query: str) -> DataFrame:
    import uuid

    return spark.createDataFrame([(str(uuid.uuid4()), query)], "question_id string, question string")


def search_query(spark: SparkSession, query: str, k: int = 10,
                 index_dir: str = DEFAULT_INDEX_DIRECTORY) -> DataFrame:
    """Blank query and negative k are errors; k = 0 gives no sources."""
    if not isinstance(query, str) or not query.strip():
        raise ValueError("query must not be empty.")
    se.check_k(k)
    index = ix.load_index(spark, index_dir)
    return se.search_dataset(index, _one_question(spark, query), k)


def search_dataset(spark: SparkSession, dataset_path: str, save_directory: str, k: int = 10,
                   index_dir: str = DEFAULT_INDEX_DIRECTORY, json_lines: bool = False) -> str:
    """R6 + S10: rank every question of a set; one results document named
    like the input, under ``save_directory``. Repeated ids give a result
    each. ``json_lines``: question set and results are JSON Lines."""
    se.check_k(k)
    sk.check_output_directory(save_directory)
    index = ix.load_index(spark, index_dir)
    questions = qs.load_questions(spark, dataset_path, json_lines=json_lines)
    kept = se.Intermediates()
    flat = se.search_dataset(index, questions, k, kept=kept)
    out = sk.write_results(sk.nest_results(flat), save_directory, os.path.basename(dataset_path),
                           k, json_lines)
    kept.release()
    return out


def _read_sources(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = []
        for p in pdf["file_path"]:
            try:
                with open(p, encoding="utf-8") as fh:  # text mode: newlines normalised
                    texts.append(fh.read())
            except (OSError, UnicodeDecodeError):
                texts.append(None)
        yield pd.DataFrame({"file_path": pdf["file_path"], "text": texts})


def source_documents(flat: DataFrame, base_dir: str | None = None) -> DataFrame:
    """Read only the files the results point to (paths relative to
    ``base_dir``, default the current directory); unreadable -> null."""
    base = os.path.abspath(base_dir or os.getcwd())
    paths = flat.where(F.col("file_path").isNotNull()).select("file_path").distinct()
    located = paths.select("file_path", F.concat(F.lit(base + "/"), F.col("file_path")).alias("abs"))
    read = located.select(F.col("abs").alias("file_path")).mapInPandas(
        _read_sources, "file_path string, text string")
    return located.join(read.withColumnRenamed("file_path", "abs"), "abs").select(
        "file_path", normalize_newlines(F.col("text")).alias("text"))


def answer_results(flat: DataFrame, documents: DataFrame,
                   make_answerer: Callable[[], cx.AnswerFn]) -> DataFrame:
    """G1-G3 on flat results: each input position is answered by itself,
    also where ids repeat."""
    keyed = flat.drop("answer").withColumn("_id", F.col("question_id")).withColumn(
        "question_id", F.col("input_pos").cast("string"))
    located = cx.resolve_spans(keyed.where(F.col("rank").isNotNull()), documents)
    prompts = cx.build_prompts(keyed.select("question_id", "question").distinct(), located)
    answers = cx.answer_dataset(prompts, make_answerer).select("question_id", "answer")
    return keyed.join(answers, "question_id").withColumn("question_id", F.col("_id")).drop("_id")


def answer_dataset(spark: SparkSession, results_path: str, save_directory: str,
                   make_answerer: Callable[[], cx.AnswerFn], documents: DataFrame | None = None,
                   base_dir: str | None = None, json_lines: bool = False) -> str:
    """Answer every question of a results file (sources re-read from
    the corpus, or taken from ``documents``)."""
    sk.check_output_directory(save_directory)
    flat, header = qs.load_results(spark, results_path, json_lines)
    k = header.first()["k"]
    docs = documents if documents is not None else source_documents(flat, base_dir)
    out = answer_results(flat, docs, make_answerer)
    return sk.write_results(sk.nest_results(out, with_answer=True), save_directory,
                            os.path.basename(results_path), k, json_lines)


def answer_query(spark: SparkSession, query: str, make_answerer: Callable[[], cx.AnswerFn],
                 k: int = 10, index_dir: str = DEFAULT_INDEX_DIRECTORY) -> tuple[DataFrame, str]:
    """Search, then answer from the chunk texts themselves."""
    if not isinstance(query, str) or not query.strip():
        raise ValueError("query must not be empty.")
    se.check_k(k)
    index = ix.load_index(spark, index_dir)
    res = se.search(index, _one_question(spark, query), k)
    with_text = res.join(index.chunks.select("file_path", "first_character_index", "text"),
                                      ["file_path", "first_character_index"])
    # k rows at most: gathered on the driver for the one call.
    texts = [r["text"] for r in with_text.orderBy("rank").select("text").collect()]
    return res, cx.answer_one(query, texts, make_answerer)


def evaluate(spark: SparkSession, results_path: str, dataset_path: str,
             json_lines: bool = False) -> tuple[DataFrame, str]:
    """(cutoff, mean_recall) and the report text. ``json_lines``:
    results and question set are JSON Lines."""
    flat, _ = qs.load_results(spark, results_path, json_lines)
    results = ev.last_wins(flat, order="input_pos")
    results = flat.join(results.select("question_id", "input_pos"), ["question_id", "input_pos"])
    gold = qs.gold_from_questions(qs.load_questions(spark, dataset_path, json_lines=json_lines))
    recall = ev.recall_at_k(gold, results)
    lines = [r["line"] for r in ev.recall_report(recall).orderBy("cutoff").collect()]
    return recall, "\n".join(["Evaluation Results", "=" * 40] + lines)


def load_dataset(spark: SparkSession, dataset_path: str, json_lines: bool = False) -> str:
    q = qs.load_questions(spark, dataset_path, json_lines=json_lines)
    n = qs.question_count(q).first()["n_questions"]
    return f"Dataset loaded successfully: {n} questions."


def copy_dataset(spark: SparkSession, src: str, dst: str, json_lines: bool = False) -> str:
    qs.copy_questions(spark, src, dst, json_lines)
    return f"Dataset saved successfully: {dst}"
