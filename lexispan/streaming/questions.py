"""Questions arriving as a stream, ranked against a saved index.

Batch search (R6) run per micro-batch: a file source watches a folder of
JSON Lines question files, ``foreachBatch`` validates the lines like a
batch set (S6) and ranks them against the (static, Parquet) index. Every
epoch is written to its own folders with overwrite, so a replayed epoch
after a failure rewrites the same output: ``results`` holds a row per
question and source, ``rejected`` every line that is no valid question,
with the reason. Progress lives in the checkpoint location, by default
under the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexispan.operators import index as ix
from lexispan.operators import search as se
from lexispan.session import ensure_checkpoint_dir
from lexispan.sources import questions as qs


def search_stream(spark: SparkSession, index_dir: str, source_dir: str, sink_dir: str,
                  k: int = 10, checkpoint: str | None = None, available_now: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``available_now``: process what is in ``source_dir`` and stop (a
    backfill run); otherwise run until stopped.
    """
    se.check_k(k)
    index = ix.load_index(spark, index_dir)
    # Rebuilds leave the version that this stream reads in place.
    lease = ix.Lease(spark, index)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(source_dir)
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "search-stream-"
                                            + os.path.basename(os.path.normpath(sink_dir)))

    def rank_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.where(F.length(F.trim("value")) > 0)
        placed = batch.withColumn("input_pos", F.monotonically_increasing_id())
        # Fixed before use: line numbers hang on how a batch is read.
        placed.write.mode("overwrite").parquet(f"{checkpoint}-lines/epoch={epoch_id}")
        placed = spark.read.schema(placed.schema).parquet(f"{checkpoint}-lines/epoch={epoch_id}")
        table = qs.validate_items(qs.parse_lines(placed), f"{source_dir}:{epoch_id}")
        lease.renew_if_due()
        kept = se.Intermediates()
        res = se.search_dataset(index, table.where("is_valid"), k, kept=kept)
        res.drop("input_pos").write.mode("overwrite").parquet(os.path.join(sink_dir, "results", f"epoch={epoch_id}"))
        bad = table.where(~F.col("is_valid")).select("input_pos", "reason").join(placed, "input_pos")
        bad.select("value", "reason").write.mode("overwrite").parquet(
            os.path.join(sink_dir, "rejected", f"epoch={epoch_id}"))
        kept.release()

    writer = lines.writeStream.foreachBatch(rank_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_stream_results(spark: SparkSession, sink_dir: str) -> DataFrame:
    """All epochs written so far (``epoch`` comes from the folder name)."""
    return spark.read.parquet(os.path.join(sink_dir, "results"))


def read_stream_rejects(spark: SparkSession, sink_dir: str) -> DataFrame:
    """(value, reason, epoch) of all lines that were no valid question."""
    return spark.read.parquet(os.path.join(sink_dir, "rejected"))
