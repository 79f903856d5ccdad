"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import itertools
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lexispan.llm.words import row_slices
from lexispan.session import ensure_checkpoint_dir, ship_package
from lexispan.sources.files import Files

#: Remainder of crc32(doc_id as text) mod FOLDS that is never learnt from.
FOLDS, HELD_OUT = 4, 2
#: Bytes of texts scored at a time: a worker's arrays are many times that.
SLICE_BYTES = 1 << 20
#: Largest table, in bytes, that is broadcast. Executors hold several.
BROADCAST_BYTES = 8 << 20
#: Of intermediate tables. The default codec takes buffers outside the heap
#: for each file and column, which stay until the heap is collected.
CODEC = "zstd"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: values that depend on how rows were dealt out
    (row numbers, range partitions) are fixed from here on, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one operator's run below the shared checkpoint folder,
    deleted as soon as later steps no longer read them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
        self.files = Files(spark, self.root)
        self._paths: list[tuple[DataFrame, str]] = []

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and read it back, as ``shared_table`` does."""
        path = f"{self.root}/{len(self._paths)}-{label}"
        df.write.parquet(path, compression=CODEC)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths.append((back, path))
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later action reads, and let go of the
        shuffle files of finished steps."""
        for table, path in self._paths:
            if any(table is t for t in tables):
                self.files.delete(path)
        let_go(self.spark)

    def drop_all_but(self, *kept: DataFrame) -> None:
        self.drop(*[t for t, _ in self._paths if not any(t is k for k in kept)])


def let_go(spark: SparkSession) -> None:
    """Spark deletes a shuffle's files once the driver's collector finds
    that no plan refers to it; ask for that now, as a busy session does
    so only when its heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_within(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a written table, marked for broadcast if its rows of
    ``row_bytes`` are at most ``limit`` bytes; else the planner chooses."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often
    the body's own lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def text_hash(text_col: str) -> Column:
    """Hash of a whole text, 64 bits; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` whose id and text are not among ``gone``
    (doc_id, text_hash), all columns, whatever their names. Other texts
    of an id stay. The texts stay where they are read while ``gone`` is
    small enough to be broadcast."""
    names = free_names(docs, 2)
    gone = scratch.table(gone.select(
        F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).distinct(), "gone")
    same = docs[id_col].eqNullSafe(gone[names[0]]) & (text_hash(text_col) == gone[names[1]])
    scratch.drop_all_but(gone)
    return docs.join(broadcast_within(gone, 64), same, "left_anti")


def free_names(df: DataFrame, count: int) -> list[str]:
    """Column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return list(itertools.islice((n for i in itertools.count() if (n := f"_own_{i}") not in taken), count))


def held_out(id_col: Column) -> Column:
    """True for rows kept out of training; a null id counts as empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(FOLDS)) == HELD_OUT


def gapless_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the given order.

    The rows are dealt by range over (keys, order), so a key that holds
    a large share of the rows spreads over many tasks. Each task numbers
    its own rows per key; the counts of the ranges before it, one row
    per key and range, are added as an offset. ``order`` should leave
    few ties: equal rows share a range.
    """
    ranged = shared_table(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_range").alias("_o_range"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order)) - 1
    same = F.col("_range") == F.col("_o_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    numbered = ranged.withColumn("_local", local).join(offsets, same)
    return numbered.select(*df.columns, (F.col("_before") + F.col("_local")).cast("long").alias(out))


def with_workers(spark: SparkSession) -> None:
    """Checkpoint folder and package on the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def bounded_choice(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About ``rows`` rows, those of the smallest hashes of ``key``, at
    most twice as many. Only hashes are sorted; the rows themselves are
    filtered where they lie."""
    order = F.xxhash64(*key)
    last = df.select(order.alias("k")).orderBy("k").limit(rows).agg(F.max("k")).first()[0]
    return df.limit(0) if last is None else df.where(order <= last).limit(2 * rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts, labels (bool) and weights of at most ``per_label`` rows of
    each label, for fitting on the driver.

    Rows held out, without a label or without a document are left out;
    of an id's labels the largest counts, of its texts the one of the
    smallest hash. The choice goes by a hash of the id; weights undo the
    unequal sampling of the labels.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = [known.where(F.col("_label") == v).orderBy(*order).limit(per_label) for v in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_label rows of two numbers
    # The table's own columns, whatever their names, stay behind.
    texts = docs.select(F.col(id_col).alias("_own"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(chosen), F.col("_own") == F.col("_id")).groupBy("_id", "_label").agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    table = found.toArrow().sort_by("_id")
    flags = table["_label"].to_numpy().astype(bool)
    weights = np.ones(len(flags))
    for value in (False, True):
        mine = flags == value
        weights[mine] = sizes.get(int(value), 0) / max(mine.sum(), 1)
    texts = table["_text"].combine_chunks()
    del table
    return texts, flags, weights / max(weights.mean(), 1e-9) if len(weights) else weights


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], cut: float,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in row_slices(batch.column("text"), SLICE_BYTES):
                values = score(batch.column("text").slice(at, end - at))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, end - at), batch.column("held_out").slice(at, end - at),
                     pa.array(values, pa.float64()), pa.array(values >= cut).cast(pa.int32())],
                    names=["doc_id", "held_out", "score", "predicted"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def scored_from(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], cut: float,
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose whole text's score reaches ``cut``, all
    columns as they are: the rows pass the scorer whole, so none of them
    is joined or moved. Null texts are scored as empty ones."""
    place = docs.columns.index(next(c for c in docs.columns if c.lower() == text_col.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(place).fill_null("")
            for at, end in row_slices(texts, SLICE_BYTES):
                keep = pa.array(score(texts.slice(at, end - at)) >= cut)
                rows = batch.column("row").slice(at, end - at).filter(keep)
                yield pa.RecordBatch.from_arrays([rows], names=["row"])
            pa.default_memory_pool().release_unused()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([T.StructField("row", docs.schema, False)])
    return whole.mapInArrow(run, schema).select("row.*")
