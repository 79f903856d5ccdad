"""Span-overlap evaluation: IoU match and mean recall@c.

One equi-join of gold spans and retrieved spans on (question_id,
file_path), an IoU predicate, one ``min(rank)`` aggregation per gold
span, and the four cutoffs derived from it in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispan.functions.spans import interval_iou

# Match threshold and the reported cutoffs.
IOU_THRESHOLD = 0.05
CUTOFFS = (1, 3, 5, 10)


def last_wins(df: DataFrame, key: str = "question_id", order: str = "input_pos") -> DataFrame:
    """E5: keep the last row (largest ``order``) of each key.

    A ``max_by`` aggregation, so it combines map-side: an id repeated in
    a large share of the rows is reduced in every task before the
    shuffle instead of landing whole in one window partition.
    """
    others = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_last"))
    return last.select(key, *[F.col("_last")[c].alias(c) for c in others]).select(*df.columns)


def gold_table(gold: DataFrame) -> DataFrame:
    """Number gold spans per question (duplicates each count):
    (question_id, gold_pos, file_path, first, last)."""
    if "gold_pos" in gold.columns:
        return gold
    w = Window.partitionBy("question_id").orderBy(
        "file_path", "first_character_index", "last_character_index")
    return gold.withColumn("gold_pos", F.row_number().over(w))


def span_pairs(gold: DataFrame, results: DataFrame) -> DataFrame:
    """Gold x retrieved pairs on the same question and file, with IoU."""
    g = gold.select("question_id", "gold_pos", "file_path",
                    F.col("first_character_index").alias("g_first"),
                    F.col("last_character_index").alias("g_last"))
    r = results.where(F.col("rank").isNotNull()).select(
        "question_id", "rank", "file_path",
        F.col("first_character_index").alias("r_first"),
        F.col("last_character_index").alias("r_last"))
    pairs = g.join(r, ["question_id", "file_path"])
    iou = interval_iou(F.col("g_first"), F.col("g_last"), F.col("r_first"), F.col("r_last"))
    return pairs.withColumn("iou", iou).withColumn("is_match", F.col("iou") >= F.lit(IOU_THRESHOLD))


def best_match_rank(gold: DataFrame, results: DataFrame) -> DataFrame:
    """Per gold span: the best rank of a matching retrieved span (null if none)."""
    pairs = span_pairs(gold, results).where("is_match")
    best = pairs.groupBy("question_id", "gold_pos").agg(F.min("rank").alias("best_rank"))
    return gold.select("question_id", "gold_pos").join(best, ["question_id", "gold_pos"], "left")


def recall_per_question(gold: DataFrame, results: DataFrame,
                        cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """(question_id, cutoff, recall). Questions absent from the results
    score 0; questions without gold spans are not in ``gold``."""
    best = best_match_rank(gold, results)
    cut = F.explode(F.array(*[F.lit(c) for c in cutoffs])).alias("cutoff")
    return (best.select("question_id", "best_rank", cut)
            .groupBy("question_id", "cutoff")
            .agg(F.avg(F.when(F.col("best_rank") <= F.col("cutoff"), 1.0).otherwise(0.0)).alias("recall")))


def recall_at_k(gold: DataFrame, results: DataFrame, cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """(cutoff, mean_recall); every cutoff appears, 0.0 without questions."""
    per_q = recall_per_question(gold, results, cutoffs)
    means = per_q.groupBy("cutoff").agg(F.avg("recall").alias("mean_recall"))
    spark = gold.sparkSession
    all_cuts = spark.createDataFrame([(c,) for c in cutoffs], "cutoff int")
    return all_cuts.join(F.broadcast(means), "cutoff", "left").select(
        "cutoff", F.coalesce(F.col("mean_recall"), F.lit(0.0)).alias("mean_recall"))


def recall_report(recall: DataFrame) -> DataFrame:
    """``Recall@c: 0.650 (65.0%)`` lines, one per cutoff."""
    return recall.select("cutoff", F.format_string(
        "Recall@%d: %.3f (%.1f%%)", F.col("cutoff"), F.col("mean_recall"),
        F.col("mean_recall") * 100).alias("line"))
