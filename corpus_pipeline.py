"""Training-data pipeline over ``documents``.

STAGES are applied in order; each result is written as Parquet and
reread as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexispan.llm import decontamination, exact_dedup, near_dedup, packing, quality
from lexispan.llm.common import read_table, shared_table, with_workers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted poor go."""
    with_workers(spark)
    return quality.drop_poor(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    with_workers(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest id stays."""
    with_workers(spark)
    return near_dedup.drop_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    with_workers(spark)
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces in sequences."""
    with_workers(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_texts),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: The first stage scores with a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    with_workers(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
