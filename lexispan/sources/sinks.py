"""Result sinks (S10): nested search results / answers as JSON.

``nest_results`` groups the flat ranking (at most k rows per question,
so each group is bounded) into one row per question with its
``retrieved_sources`` in rank order. ``write_results`` writes either
the one-document format (one file, streamed line by line by one writer
task) or JSON Lines (one question per line, written in
parallel) for large batches.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.sources.files import Files


def check_output_directory(path: str) -> None:
    """An existing regular file where the output directory should be is an error."""
    if os.path.exists(path) and not os.path.isdir(path):
        raise NotADirectoryError(f"expected an output directory, got file: {path}")


def nest_results(flat: DataFrame, with_answer: bool = False) -> DataFrame:
    """(question_id, question, rank, file_path, first, last[, answer]) ->
    (input order kept by ``input_pos`` when present) one row per question."""
    src = F.struct("rank", "file_path", "first_character_index", "last_character_index")
    keys = ["question_id", "question"] + (["answer"] if with_answer else [])
    order = ["input_pos"] if "input_pos" in flat.columns else []
    grouped = flat.groupBy(*order, *keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), src))).alias("s"))
    sources = F.transform("s", lambda x: F.struct(
        x["file_path"].alias("file_path"),
        x["first_character_index"].alias("first_character_index"),
        x["last_character_index"].alias("last_character_index")))
    return grouped.select(*order, *keys, sources.alias("retrieved_sources"))


def document_lines(items: DataFrame, head: str, tail: str) -> DataFrame:
    """Lines of one JSON document ``head item, item, ... tail``.

    ``items``: (key, j) with ``j`` one JSON value per row, ordered by
    ``key``. Every item is its own line (comma-prefixed except the first,
    found by a scalar ``min``), so the document is streamed row by row
    and never assembled in one row or one group. Columns: section, key,
    value; write them ordered by (section, key).
    """
    first = items.select(F.min("key")).scalar()
    body = items.select(F.lit(1).alias("section"), "key",
                        F.when(F.col("key") == first, F.col("j"))
                        .otherwise(F.concat(F.lit(","), F.col("j"))).alias("value"))
    spark = items.sparkSession
    key_type = items.schema["key"].dataType.simpleString()
    edges = spark.createDataFrame([(0, head), (2, tail)], "section int, value string")\
        .select("section", F.lit(None).cast(key_type).alias("key"), "value")
    return edges.unionByName(body)


def write_document(lines: DataFrame, path: str) -> None:
    """Write ``document_lines`` as one file called ``path``: one writer
    task streams the rows in order into a folder beside it, whose only
    part file is then moved to the name."""
    spark = lines.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}.parts"
    lines.orderBy("section", "key").select("value").coalesce(1).write.text(folder)
    files = Files(spark, folder)
    part = next(n for n in files.names(folder) if n.startswith("part-"))
    files.move(f"{folder}/{part}", path)
    files.delete(folder)


def results_lines(nested: DataFrame, k: int) -> DataFrame:
    """Lines of ``{"search_results": [...], "k": k}``, items in input order."""
    cols = [c for c in ("question_id", "question", "retrieved_sources", "answer") if c in nested.columns]
    order = "input_pos" if "input_pos" in nested.columns else "question_id"
    items = nested.select(F.col(order).alias("key"), F.to_json(F.struct(*cols)).alias("j"))
    return document_lines(items, '{"search_results": [', f'], "k": {int(k)}}}')


def write_results(nested: DataFrame, directory: str, name: str, k: int,
                  json_lines: bool = False) -> str:
    """Write results under ``directory/name``; returns the path."""
    check_output_directory(directory)
    target = os.path.join(directory, name)
    if json_lines:
        ordered = nested.orderBy("input_pos") if "input_pos" in nested.columns else nested
        ordered.withColumn("k", F.lit(int(k))).write.mode("overwrite").json(target)
    else:
        write_document(results_lines(nested, k), target)
    return target
