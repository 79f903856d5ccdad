"""Benchmark decontamination: size-partitioned MinHash containment.

The Jaccard similarity of a short item and a long document is tiny even
where the document holds all of the item, so signatures of both sides
cannot find such pairs. Min-wise samples of the item alone can: the
shingle at which a random hash function is smallest over the item is
one of the document's with the probability of the containment, however
long the document is. Documents are partitioned by size, items are
searched only in partitions that can hold enough of their shingles, and
pairs with enough sample hits are verified on the exact sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.common import Scratch, let, shared_table, without

WIDTH, THRESHOLD = 5, 0.75
#: Hash functions, and sample hits a candidate needs: a pair whose
#: containment is 0.75 has fewer with probability 1e-9.
SAMPLES, HITS = 32, 8
#: Largest size of the samples, in bytes, at which they are broadcast.
BROADCAST_BYTES = 64 << 20
_SAMPLE_BYTES = 32

_WORD = r"[^\x20\x09-\x0D]+"


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the runs of ``width`` words of a text, repeats included;
    a shorter text's whole sequence is one, no words give none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        return F.when(F.size(w) > 0, F.transform(
            starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))).otherwise(
            F.array().cast("array<bigint>"))
    return let(words, runs)


def _all_shingles(text: Column, widths: list[int]) -> Column:
    """Shingles of several widths, one list."""
    return F.concat(*[shingles(text, width) for width in widths])


def _size_class(n: Column) -> Column:
    """Partition of a set's size: powers of four."""
    return F.ceil(F.log(4.0, F.greatest(n, F.lit(1)).cast("double"))).cast("int")


def _samples(items: DataFrame) -> DataFrame:
    """(item, n_item, shingle, weight): the min-wise samples of each
    item, with the number of hash functions that chose the shingle."""
    def least(i: Column) -> Column:
        ranked = F.transform("shingles", lambda s: F.struct(F.xxhash64(s, i).alias("h"), s.alias("s")))
        return F.array_min(ranked)["s"]
    chosen = F.transform(F.sequence(F.lit(1), F.lit(SAMPLES)), least)
    return items.select("item", "n_item", F.explode(chosen).alias("shingle")).groupBy(
        "item", "n_item", "shingle").agg(F.count(F.lit(1)).alias("weight"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of documents and benchmark items they contain.

    Returns doc_id, item_id, n_item, n_shared, containment and text_hash
    (of the document's text) for every pair of which the document holds
    at least ``threshold`` of the item's distinct five-word shingles
    (lower case; words are runs outside 0x09-0x0D and 0x20). An item of
    fewer words is one shingle of its own width, which a document holds
    where these words stand in a row. Null and
    wordless texts hold nothing and are held by nothing. Repeated rows
    of one id and text give one pair for each item row. Empty tables
    give an empty result; other columns are not read.
    """
    percent = round(100 * threshold)
    items = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"),
        F.array_distinct(shingles(F.col(item_text))).alias("shingles"))
    items = shared_table(items.withColumn("n_item", F.size("shingles")).where("n_item > 0"), "items")
    # Documents are read in the items' widths: WIDTH, and up to four more.
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(item_text), F.lit("")), F.lit(_WORD), F.lit(0)))
    short = benchmark.select(words.alias("width")).where(F.col("width").between(1, WIDTH - 1)).distinct()
    widths = [WIDTH, *sorted(r["width"] for r in short.collect())]
    samples = shared_table(_samples(items), "samples")
    if samples.count() * _SAMPLE_BYTES <= BROADCAST_BYTES:
        samples = F.broadcast(samples)

    key = [F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")]
    own = docs.select(*key, _all_shingles(F.col(text_col), widths).alias("all"))
    spread = own.select("doc_id", "text_hash", _size_class(F.size("all")).alias("size_class"),
                        F.explode("all").alias("shingle"))
    # The largest set of a document's partition has 4^size_class shingles.
    enough = F.pow(F.lit(4.0), F.col("size_class")) * 100 >= F.col("n_item") * percent
    hits = spread.join(samples, "shingle").where(enough)
    hits = hits.groupBy("doc_id", "text_hash", "item", "shingle").agg(F.max("weight").alias("weight"))
    found = hits.groupBy("doc_id", "text_hash", "item").agg(F.sum("weight").alias("hits")).where(
        F.col("hits") >= HITS)
    candidates = shared_table(found.select("doc_id", "text_hash", "item"), "candidates")

    wanted = candidates.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    full = docs.select(*key, F.col(text_col).alias("_text")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
    full = full.dropDuplicates(["doc_id", "text_hash"]).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), _all_shingles(F.col("_text"), widths).alias("all"))
    pairs = candidates.join(items, "item").join(
        full, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    shared = F.size(F.array_intersect("shingles", "all"))
    pairs = pairs.select("doc_id", "item_id", "n_item", shared.alias("n_shared"), "text_hash")
    return pairs.where(F.col("n_shared") * 100 >= F.col("n_item") * percent).select(
        "doc_id", "item_id", "n_item", "n_shared",
        F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment"), "text_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns,
    whatever their names. Of rows that share an id, null or not, each
    goes by its own text; null texts hold nothing and stay; empty tables
    drop nothing."""
    return without(docs, contaminated(docs, benchmark, id_col, text_col), id_col, text_col, Scratch(docs.sparkSession))
