"""Spread under-partitioned inputs over the cluster.

A large input arrives as many file splits and is left alone (no extra
shuffle). A small one (fewer splits than task slots, e.g. one Parquet
row group) is round-robin repartitioned so per-row work such as
chunking and tokenizing uses every core.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, factor: int = 2) -> DataFrame:
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots * factor)
    return df
