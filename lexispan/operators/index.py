"""BM25 inverted index as DataFrames.

* ``chunks``   (chunk_id, file_path, first_character_index, last_character_index, text, dl)
* ``postings`` (token, chunk_id, tf, dl, tfn), in groups of consecutive chunk ids
* ``terms``    (token, df, idf, max_tfn)
* ``stats``    one row (n_chunks, avgdl, average_idf)

``chunk_id`` is the chunk's number in corpus order, from 0 without gaps:
the corpus is dealt by range of its paths and sorted once, a chunk's place
in its range is fixed when the chunk table is written (or persisted),
and the ranges' sizes, one number each, give every range its first id.
So ties of a ranking go by ``chunk_id``, the first n chunks of the corpus
are ``chunk_id < n``, and the postings carry no paths.
``tfn`` is the BM25 term-frequency factor
``tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl))``, fixed per index;
``max_tfn`` is a token's largest, from which a search bounds scores.

Chunks are tokenized once; the token lists stay with the chunk table.
Postings are dealt by chunk (the lists cross the network once), so that
counting a chunk's tokens and later summing its scores need no further
shuffle; document frequency shuffles by token, after map-side partial
aggregation. A saved index is a versioned folder, published by a marker
file once it is complete.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.text import STOP_WORDS, TOKEN_PATTERN, corpus_order, tokenize
from lexispan.operators.chunking import DEFAULT_CHUNK_SIZE, check_chunk_size, chunk_in_order
from lexispan.sources.files import Files

# BM25 parameters and the idf floor factor.
K1 = 1.0
B = 0.4
IDF_FLOOR_FACTOR = 0.25

FORMAT_VERSION = 5
# Tokens of an index in memory that one task counts.
TASK_TOKENS = 1_000_000
# Bytes of chunks whose postings share one file, and files of a group:
# a group is a bucketed table, whose buckets Spark limits to 100,000.
POSTINGS_BYTES = 128 << 20
GROUP_FILES = 50_000
# Published versions kept in an index folder besides leased ones.
VERSIONS = 2
# Seconds for which a reader's lease holds unless it is renewed.
LEASE_SECONDS = 24 * 3600


@dataclass
class BM25Index:
    # Token lists by (part, place): the chunk's range and place in it.
    tokenized: DataFrame
    chunks: DataFrame | None = None
    # Disjoint, consecutive ranges of chunk ids, one table each.
    groups: list[DataFrame] = field(default_factory=list)
    terms: DataFrame | None = None
    stats: DataFrame | None = None
    k1: float = K1
    b: float = B
    chunk_size: int = DEFAULT_CHUNK_SIZE
    on_disk: bool = False  # Parquet-backed (a token filter can skip row groups)
    n_chunks: int = 0
    # True when every idf is >= 0 (average raw idf >= 0): no score is negative.
    nonnegative_idf: bool = False
    # Folder and version of a saved index.
    path: str | None = None
    version: str | None = None

    @property
    def postings(self) -> DataFrame:
        """The postings of all groups."""
        return reduce(DataFrame.unionByName, self.groups)

    @property
    def prefix_rows(self) -> int:
        return self.n_chunks

    @property
    def prefix(self) -> DataFrame:
        """All chunks' keys with their position ``pos`` (from 1) in corpus
        order; a filter on it reads the first ranges' files only."""
        keys = self.chunks.select("chunk_id", "file_path", "first_character_index", "last_character_index")
        return keys.withColumn("pos", F.col("chunk_id") + 1)


def index_tokens(file_path: Column | str = "file_path", text: Column | str = "text") -> Column:
    """T-2: tokens of the path followed by tokens of the text."""
    return F.concat(tokenize(file_path), tokenize(text))


def tokenized_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.select(*chunks.columns, index_tokens().alias("tokens"))


def tf_factor(tf: Column, dl: Column, avgdl: Column, k1: float, b: float) -> Column:
    """BM25 term-frequency factor of one (chunk, token)."""
    tf = tf.cast("double")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl.cast("double") / avgdl)
    return (tf * F.lit(k1 + 1.0)) / (tf + norm)


def postings_from_tokens(tok: DataFrame, avgdl: Column | None = None,
                         k1: float = K1, b: float = B, files: int | None = None) -> DataFrame:
    """One row per (chunk, token): tf, the chunk length and, given
    ``avgdl``, the BM25 tf factor. ``files``: deal the token lists by
    chunk to that many partitions first; the count needs no other."""
    lists = tok.select("chunk_id", F.size("tokens").alias("dl"), "tokens")
    if files:
        lists = lists.repartition(files, "chunk_id")
    out = (lists.select("chunk_id", "dl", F.explode("tokens").alias("token"))
           .groupBy("chunk_id", "dl", "token").agg(F.count(F.lit(1)).cast("int").alias("tf"))
           .select("token", "chunk_id", "tf", "dl"))
    if avgdl is not None:
        out = out.withColumn("tfn", tf_factor(F.col("tf"), F.col("dl"), avgdl, k1, b))
    return out


def chunk_lengths(tok: DataFrame) -> DataFrame:
    """``dl`` per chunk (tokens after stop-words, path included)."""
    return tok.select("chunk_id", "file_path", "first_character_index", "last_character_index",
                      F.size("tokens").alias("dl"))


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """Number of chunks and mean length over all chunks."""
    return lengths.agg(F.count(F.lit(1)).alias("n_chunks"),
                       F.avg(F.col("dl").cast("double")).alias("avgdl"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """Chunks containing each token."""
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def raw_idf(df_col: Column, n_chunks: Column) -> Column:
    n = n_chunks.cast("double")
    d = df_col.cast("double")
    return F.ln(n - d + F.lit(0.5)) - F.ln(d + F.lit(0.5))


def idf_with_floor(dfreq: DataFrame, n_chunks: Column) -> tuple[DataFrame, Column]:
    """I4: idf, negative values replaced by 0.25 x the mean raw idf.

    Returns the terms table and the (scalar subquery) average idf.
    """
    raw = dfreq.select("token", "df", raw_idf(F.col("df"), n_chunks).alias("idf_raw"))
    average = raw.select(F.avg("idf_raw")).scalar()
    terms = raw.select(
        "token", "df",
        F.when(F.col("idf_raw") < 0, F.lit(IDF_FLOOR_FACTOR) * average)
        .otherwise(F.col("idf_raw")).alias("idf"))
    return terms, average


PLACE_BITS = 33  # of monotonically_increasing_id


def placed(chunks: DataFrame) -> DataFrame:
    """Chunks in corpus order with their partition ``part`` and their
    ``place`` in it."""
    number = F.monotonically_increasing_id()
    return chunks.select(F.spark_partition_id().alias("part"),
                         number.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"),
                         "file_path", "first_character_index", "last_character_index", "text")


def in_corpus_order(df: DataFrame, *then: str) -> DataFrame:
    """Rows dealt by range of their path and sorted: components first,
    then ``then``. The ranges are as many as the session's shuffle
    partitions or task slots."""
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    order = [corpus_order("file_path"), *then]
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def _offsets(tok: DataFrame) -> tuple[DataFrame, int, float]:
    """First chunk id of every range (part, first_id), and the number of
    chunks and their mean length: one row a range reaches the driver."""
    sizes = tok.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("length")).orderBy("part").collect()
    rows, first = [], 0
    for r in sizes:
        rows.append((r["part"], first))
        first += r["n"]
    offsets = tok.sparkSession.createDataFrame(rows, "part int, first_id bigint")
    return offsets, first, sum(r["length"] for r in sizes) / first if first else 0.0


def with_chunk_ids(tok: DataFrame, offsets: DataFrame) -> DataFrame:
    """``chunk_id`` of placed chunks; ``offsets`` has a row for each range."""
    return tok.join(F.broadcast(offsets), "part").withColumn("chunk_id", F.col("first_id") + F.col("place")).drop(
        "part", "place", "first_id")


def _chunk_table(tok: DataFrame, offsets: DataFrame) -> DataFrame:
    return with_chunk_ids(tok.drop("tokens"), offsets).select(
        "chunk_id", "file_path", "first_character_index", "last_character_index", "text", "dl")


def _floored(average: float, n_chunks: int) -> Column:
    raw = raw_idf(F.col("df"), F.lit(n_chunks))
    return F.when(raw < 0, F.lit(IDF_FLOOR_FACTOR) * F.lit(average).cast("double")).otherwise(raw)


def _token_counts(groups: list[DataFrame]) -> DataFrame:
    """I3 with the largest tf factor of each token."""
    return reduce(DataFrame.unionByName, groups).groupBy("token").agg(
        F.count(F.lit(1)).alias("df"), F.max("tfn").alias("max_tfn"))


def _stats(spark: SparkSession, n_chunks: int, avgdl: float, average: float | None) -> DataFrame:
    return spark.range(1).select(F.lit(n_chunks).cast("bigint").alias("n_chunks"),
                                 F.lit(avgdl).cast("double").alias("avgdl"),
                                 F.lit(average).cast("double").alias("average_idf"))


def _index_of(chunks: DataFrame, k1: float, b: float, chunk_size: int, materialize: bool) -> BM25Index:
    """I1-I4 over chunks in corpus order.

    With ``materialize`` the tokenized chunks are persisted (on local
    disk, so that the executors' memory is the tasks'; a lost block is
    recomputed from its deterministic lineage), the ranges are counted,
    and the postings are persisted
    clustered by chunk (scoring then sums per question and chunk without
    a shuffle). Otherwise only the chunks' token lists are planned, for
    ``save_index`` to write.
    """
    tok = tokenized_chunks(placed(chunks)).withColumn("dl", F.size("tokens"))
    index = BM25Index(tok, k1=k1, b=b, chunk_size=chunk_size)
    if not materialize:
        return index
    spark = chunks.sparkSession
    index.tokenized = tok = tok.persist(StorageLevel.DISK_ONLY)
    offsets, n_chunks, avgdl = _offsets(tok)
    # As many partitions as keep a task's counts in memory.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_chunks * avgdl / TASK_TOKENS))
    counts = postings_from_tokens(with_chunk_ids(tok, offsets), files=parts).persist(StorageLevel.DISK_ONLY)
    postings = counts.withColumn("tfn", tf_factor(F.col("tf"), F.col("dl"), F.lit(avgdl), k1, b))
    counted = _token_counts([postings]).persist(StorageLevel.DISK_ONLY)
    average = counted.agg(F.avg(raw_idf(F.col("df"), F.lit(n_chunks)))).first()[0]
    index.chunks, index.groups = _chunk_table(tok, offsets), [postings]
    index.terms = counted.select("token", "df", _floored(average, n_chunks).alias("idf"), "max_tfn")
    index.stats, index.n_chunks = _stats(spark, n_chunks, avgdl, average), n_chunks
    index.nonnegative_idf = average is not None and average >= 0
    return index


def build_index_from_chunks(chunks: DataFrame, k1: float = K1, b: float = B,
                            chunk_size: int = DEFAULT_CHUNK_SIZE,
                            materialize: bool = True) -> BM25Index:
    """I1-I4 over a chunk table (file_path, first_character_index,
    last_character_index, text) in any order."""
    return _index_of(in_corpus_order(chunks, "first_character_index"), k1, b, chunk_size, materialize)


def build_index(documents: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
                k1: float = K1, b: float = B, materialize: bool = True) -> BM25Index:
    """Documents -> chunks -> index. The documents are put in corpus
    order, from which their chunks follow in order. The empty-corpus
    error is raised by ``save_index``. For an index that is going to be
    saved, pass ``materialize=False`` (nothing is cached)."""
    check_chunk_size(chunk_size)
    documents = documents.select("file_path", "text")
    return _index_of(chunk_in_order(in_corpus_order(documents), chunk_size, documents), k1, b, chunk_size, materialize)


POSTINGS_DDL = "token STRING, chunk_id BIGINT, tf INT, dl INT, tfn DOUBLE"


def _postings_table(version: str, group: int) -> str:
    """Session-catalog name of a group's bucketed postings: versions
    never change, so sessions that share a catalog agree on it."""
    return f"lexispan_postings_{version}_{group}"


def _open_postings(spark: SparkSession, base: str, version: str, group: int, buckets: int) -> DataFrame:
    """Open a group's bucketed files as an external table (the bucket
    layout is only visible through the catalog)."""
    location = _postings_folder(base, group)
    if "://" not in location and not location.startswith("file:"):
        location = os.path.abspath(location)
    escaped = location.replace("\\", "\\\\").replace("'", "\\'")
    table = _postings_table(version, group)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({POSTINGS_DDL}) USING parquet "
              f"CLUSTERED BY (chunk_id) SORTED BY (token) INTO {buckets} BUCKETS LOCATION '{escaped}'")
    return spark.table(table)


def _postings_folder(base: str, group: int) -> str:
    return f"{base}/postings/group={group}"


def _stop_word_digest() -> str:
    return hashlib.sha256(("\n".join(STOP_WORDS) + "\n" + TOKEN_PATTERN).encode()).hexdigest()


def _postings_files(spark: SparkSession, chunk_bytes: int) -> int:
    """Files of the postings, by the size of the chunk table: large ones
    of POSTINGS_BYTES each, small ones spread over the task slots."""
    slots = spark.sparkContext.defaultParallelism
    return max(math.ceil(chunk_bytes / POSTINGS_BYTES), min(slots, math.ceil(chunk_bytes / (1 << 20))), 1)


def _grouped(n_chunks: int, files: int, group_files: int) -> tuple[list[tuple[int, int]], int]:
    """Ranges [low, high) of chunk ids of the postings' groups, and the
    buckets of each."""
    groups = min(max(math.ceil(files / group_files), 1), n_chunks)
    edges = [n_chunks * g // groups for g in range(groups + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True)), math.ceil(files / groups)


def save_index(index: BM25Index, path: str, postings_files: int | None = None,
               group_files: int = GROUP_FILES) -> BM25Index:
    """Write the index as Parquet tables plus a metadata file.

    Each call writes a new version folder and publishes it last, by a
    marker file: a failed or running build never changes what readers
    open, and removes its own folder. The chunk table (with token lists)
    is written first and the rest is derived from it, so chunking and
    tokenizing run once. The postings are groups of consecutive chunk
    ids, each bucketed by chunk and sorted by token, so scoring sums
    without a shuffle, a token filter skips row groups, and a corpus of
    any size stays within Spark's limit of buckets. Raises ``ValueError``
    for an empty corpus (nothing to index).
    """
    spark = index.tokenized.sparkSession
    if os.path.exists(path) and not os.path.isdir(path):
        raise NotADirectoryError(f"expected an output directory, got file: {path}")
    root, version = path.rstrip("/"), uuid.uuid4().hex
    files = Files(spark, root)
    try:
        _write_version(index, root, version, postings_files, group_files, files, path)
    except BaseException:
        _remove_version(spark, files, root, version)
        raise
    files.touch(f"{root}/published/{time.time_ns():020d}-{version}")
    clean_versions(spark, path)
    return load_index(spark, path)


def _write_version(index: BM25Index, root: str, version: str, postings_files: int | None, group_files: int,
                   files: Files, path: str) -> None:
    spark, base = index.tokenized.sparkSession, f"{root}/{version}"
    index.tokenized.write.parquet(f"{base}/chunks")
    tok = spark.read.parquet(f"{base}/chunks")
    offsets, n_chunks, avgdl = _offsets(tok)
    if n_chunks == 0:
        raise ValueError(f"No indexable chunks found in corpus for index: {path}")
    total = postings_files or _postings_files(spark, files.size(f"{base}/chunks"))
    ranges, buckets = _grouped(n_chunks, total, group_files)
    numbered = with_chunk_ids(tok, offsets)
    for group, (low, high) in enumerate(ranges):
        mine = numbered if len(ranges) == 1 else numbered.where(F.col("chunk_id").between(low, high - 1))
        postings_from_tokens(mine, F.lit(avgdl), index.k1, index.b, buckets).select(
            "token", "chunk_id", "tf", "dl", "tfn").write.format("parquet").option(
            "path", _postings_folder(base, group)).bucketBy(buckets, "chunk_id").sortBy("token").saveAsTable(
            _postings_table(version, group))
    # Document frequencies are counted once; idf and its floor follow
    # from that table, the mean idf is observed as it is written.
    seen = Observation()
    raw = raw_idf(F.col("df"), F.lit(n_chunks))
    _token_counts([spark.table(_postings_table(version, g)) for g in range(len(ranges))]).observe(
        seen, F.sum(raw).alias("idf"), F.count(F.lit(1)).alias("n")).write.parquet(f"{base}/terms")
    average = seen.get["idf"] / seen.get["n"] if seen.get["n"] else None
    meta = {"format_version": FORMAT_VERSION, "k1": index.k1, "b": index.b, "chunk_size": index.chunk_size,
            "stop_words": _stop_word_digest(), "buckets": buckets, "groups": len(ranges), "n_chunks": n_chunks,
            "avgdl": avgdl, "average_idf": average, "offsets": [[r["part"], r["first_id"]] for r in offsets.collect()]}
    files.write_text(f"{base}/meta.json", json.dumps(meta, sort_keys=True))


def _remove_version(spark: SparkSession, files: Files, root: str, version: str) -> None:
    """Delete a version's files and its tables' catalog entries."""
    for table in spark.catalog.listTables(pattern=f"{_postings_table(version, 0)[:-1]}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    files.delete(f"{root}/{version}")


def clean_versions(spark: SparkSession, path: str) -> None:
    """Remove published versions beyond the last VERSIONS that no reader
    holds a lease on, and leases that ran out."""
    root = path.rstrip("/")
    files = Files(spark, root)
    now, leased = time.time(), set()
    for name in files.names(f"{root}/leases"):
        until, _, version = name.partition("-")
        if int(until) < now:
            files.delete(f"{root}/leases/{name}")
        else:
            leased.add(version.partition("-")[0])
    for old in files.names(f"{root}/published")[:-VERSIONS]:
        version = old.partition("-")[2]
        if version not in leased:
            files.delete(f"{root}/published/{old}")
            _remove_version(spark, files, root, version)


class Lease:
    """A reader's hold on a saved index's version: until it is released,
    or for LEASE_SECONDS after its last renewal, rebuilds leave the
    version's files in place. A marker file below ``leases`` names the
    end of the hold, the version and the holder."""

    def __init__(self, spark: SparkSession, index: BM25Index, seconds: int = LEASE_SECONDS) -> None:
        if index.path is None:
            raise ValueError("only a saved index can be leased")
        self._files = Files(spark, index.path)
        self._folder, self._tail = f"{index.path}/leases", f"{index.version}-{uuid.uuid4().hex}"
        self._seconds, self._until = seconds, 0
        self.renew()

    def renew(self) -> None:
        """Hold the version for the full time from now on."""
        old, self._until = self._until, int(time.time()) + self._seconds
        if old != self._until:
            self._files.touch(f"{self._folder}/{self._until}-{self._tail}")
            if old:
                self._files.delete(f"{self._folder}/{old}-{self._tail}")

    def renew_if_due(self) -> None:
        if self._until - time.time() < self._seconds / 2:
            self.renew()

    def release(self) -> None:
        self._files.delete(f"{self._folder}/{self._until}-{self._tail}")


def load_index(spark: SparkSession, path: str) -> BM25Index:
    """Open the latest published version; none -> build first,
    unreadable -> rebuild."""
    root = path.rstrip("/")
    files = Files(spark, root)
    published = files.names(f"{root}/published")
    if not published:
        raise FileNotFoundError(f"No index found at {path}; run the index command first.")
    version = published[-1].partition("-")[2]
    base = f"{root}/{version}"
    try:
        meta = json.loads(files.read_text(f"{base}/meta.json"))
        tok, terms = spark.read.parquet(f"{base}/chunks"), spark.read.parquet(f"{base}/terms")
        groups = [_open_postings(spark, base, version, g, int(meta["buckets"])) for g in range(int(meta["groups"]))]
    except Exception as error:  # noqa: BLE001 - any read failure means rebuild
        raise FileNotFoundError(
            f"Index at {path} could not be loaded ({error}); run the index command again.") from error
    if meta.get("format_version") != FORMAT_VERSION or meta.get("stop_words") != _stop_word_digest():
        raise FileNotFoundError(f"Index at {path} is stale; run the index command again.")
    for name, table, columns in (
            ("chunks", tok, {"part", "place", "file_path", "first_character_index", "last_character_index",
                             "text", "dl", "tokens"}),
            ("terms", terms, {"token", "df", "max_tfn"}), ("postings", groups[0], {"token", "chunk_id", "tf", "dl", "tfn"})):
        if not columns <= set(table.columns):
            raise FileNotFoundError(f"Index at {path} has a bad '{name}' table; rebuild it.")
    n_chunks, average = int(meta["n_chunks"]), meta["average_idf"]
    offsets = spark.createDataFrame(meta["offsets"], "part int, first_id bigint")
    return BM25Index(
        tok, _chunk_table(tok, offsets), groups,
        terms.select("token", "df", _floored(average, n_chunks).alias("idf"), "max_tfn"),
        _stats(spark, n_chunks, meta["avgdl"], average), float(meta["k1"]), float(meta["b"]), int(meta["chunk_size"]),
        on_disk=True, n_chunks=n_chunks, nonnegative_idf=average is not None and average >= 0,
        path=root, version=version)
